"""Flat per-entity tables whose column names and types differ between batches."""

from __future__ import annotations

from functools import reduce
from zlib import crc32

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomledger.plans.entities import Entity
from loomledger.sources.envelope import DAY_COLUMNS, with_day

# A written file's name ends its batch label with the code of its schema.
_CODE = r"_schema_([0-9a-f]{8})[^/]*$"


def flat_path(folder: str, entity: Entity) -> str:
    return f"{folder}/{entity.source}/{entity.name}"


def schema_code(schema: T.StructType) -> str:
    """Eight hex digits that stand for the names and types of a file's columns."""
    return f"{crc32(','.join(f'{field.name}:{field.dataType.simpleString()}' for field in schema).encode()):08x}"


def write_flat(rows: DataFrame, folder: str, entity: Entity, replace: bool = True) -> None:
    """Write entity rows under their ingestion day, Snappy-compressed.

    The days present are replaced, so a rerun changes nothing; ``replace=False``
    adds a further batch to its days instead. The schema's code goes into the
    file names, by which the reader groups files.
    """
    dated = with_day(rows)
    code = schema_code(T.StructType([field for field in dated.schema if field.name not in DAY_COLUMNS]))
    (
        dated.hint("rebalance", *DAY_COLUMNS)
        .write.mode("overwrite" if replace else "append").option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .option("mapreduce.output.basename", f"{entity.source}_{entity.name}_batch_schema_{code}")
        .partitionBy(*DAY_COLUMNS).parquet(flat_path(folder, entity))
    )


def file_groups(spark: SparkSession, root: str) -> list[tuple[str, str]]:
    """(schema code, one file of it) per schema below ``root``: a file listing, no file is opened.

    Files that bear no code form a group each. So the list handed to the driver
    grows with the number of schemas and of files written by others.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option(
        "recursiveFileLookup", "true").load(root).select("path", F.regexp_extract("path", _CODE, 1).alias("code"))
    groups = files.groupBy("code", F.when(F.col("code") == "", F.col("path")).alias("own")).agg(F.min("path").alias("path"))
    return sorted((row.code, row.path) for row in groups.select("code", "path").collect())


def read_flat(spark: SparkSession, folder: str, entity: Entity) -> DataFrame:
    """Read all files as text columns, whatever type each was written with.

    Files are grouped by schema, not by day; one footer per group is opened,
    each group is read with its schema and cast to text, and the groups are
    united by column name. Reading across types directly fails, because
    merging schemas does not reconcile text with numbers.
    """
    root = flat_path(folder, entity)
    by_schema: dict[str, tuple[T.StructType, list[str]]] = {}
    found: list[tuple[T.StructType, DataFrame]] = []
    for code, path in file_groups(spark, root):
        schema = spark.read.parquet(path).schema
        if code:
            found.append((schema, spark.read.schema(schema).option("pathGlobFilter", f"*_schema_{code}*.parquet").parquet(root)))
        else:
            by_schema.setdefault(schema.json(), (schema, []))[1].append(path)
    for schema, paths in by_schema.values():
        found.append((schema, spark.read.schema(schema).option("basePath", root).parquet(*paths)))
    if not found:
        raise FileNotFoundError(f"no Parquet files below {root}")
    groups = [
        rows.select(*[F.col(f"`{field.name}`").cast("string").alias(field.name) for field in schema])
        for schema, rows in found
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), groups)
