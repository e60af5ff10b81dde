"""Tables bucketed and sorted by a key, with heavy keys kept apart.

Joins on the key of two tables with equally many buckets move no rows. A bucket
is read by one task, so keys that would fill a bucket alone are written beside.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomledger.sources.tables import materialise


@dataclass(frozen=True)
class Bucketed:
    """``rows`` lie in buckets; ``rest`` are the rows of ``heavy`` keys and those without a key."""

    key: str
    buckets: int
    rows: DataFrame
    rest: DataFrame
    heavy: DataFrame


def write_buckets(df: DataFrame, folder: str, name: str, key: str, buckets: int) -> DataFrame:
    """Write one sorted file per bucket and read the table back from the session's catalog.

    Meant for tables that are unique on ``key``, or whose heavy keys are gone.
    """
    table = f"{name}_{uuid.uuid4().hex}"
    (
        df.repartition(buckets, key)
        .write.bucketBy(buckets, key).sortBy(key).option("path", f"{folder}/{table}").format("parquet").saveAsTable(table)
    )
    return df.sparkSession.table(table)


def heavy_keys(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Keys with more rows than a bucket holds on average; there are fewer of them than buckets."""
    known = df.filter(F.col(key).isNotNull())
    mean = known.agg((F.count(F.lit(1)) / F.lit(buckets)).alias("mean")).scalar()
    return known.groupBy(key).agg(F.count(F.lit(1)).alias("__rows")).filter(F.col("__rows") > mean).select(key)


def write_bucketed(df: DataFrame, folder: str, name: str, key: str, buckets: int) -> Bucketed:
    """Split ``df``, which is read more than once and so best a written table, into buckets and rest.

    The heavy keys are broadcast: they are fewer than the buckets.
    """
    spark = df.sparkSession
    base = f"{folder}/{name}"
    heavy = materialise(spark, heavy_keys(df, key, buckets), f"{base}_heavy")
    light = df.filter(F.col(key).isNotNull()).join(F.broadcast(heavy), key, "left_anti")
    rest = df.join(F.broadcast(heavy.withColumn("__heavy", F.lit(True))), key, "left").filter(
        F.col(key).isNull() | F.col("__heavy")).drop("__heavy")
    return Bucketed(key, buckets, write_buckets(light, folder, name, key, buckets),
                    materialise(spark, rest.select(*df.columns), f"{base}_rest"), heavy)
