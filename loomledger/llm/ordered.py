"""Ranks and running values in a global order, without one task per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomledger.llm.common import settle

PLACE = "_place"


def ranked(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], xor: Sequence[str] = ()) -> DataFrame:
    """``rows`` with ``rank`` (from 0) and ``size`` within ``keys`` (not null), and the running xor of long columns.

    Rows are dealt by range over keys and order, so a key that holds a third of
    all rows spreads over a third of the places. Each place counts its own rows of
    a key; what earlier places hold is added from one row per key and place. With
    no ``keys`` the whole table is one sequence. Rows equal in keys and order are
    ranked in any order, but all differently; make ``order`` total where that matters.
    """
    placed = settle(rows.repartitionByRange(*[F.col(k) for k in keys], *order)
                    .withColumn(PLACE, F.spark_partition_id()), "ordered")
    held = placed.groupBy(*keys, PLACE).agg(F.count(F.lit(1)).alias("_n"), *[F.bit_xor(x).alias(x) for x in xor])
    earlier = Window.partitionBy(*keys).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.select(
        *keys, PLACE, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy(*keys)).alias("size"),
        *[F.coalesce(F.bit_xor(x).over(earlier), F.lit(0)).alias(f"_before_{x}") for x in xor])
    here = Window.partitionBy(*keys, PLACE).orderBy(*order)
    until = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = placed.withColumns({"_local": F.row_number().over(here),
                                **{f"_local_{x}": F.bit_xor(x).over(until) for x in xor}})
    joined = local.join(offsets, [*keys, PLACE])
    kept = [c for c in rows.columns if c not in xor]
    return joined.select(
        *kept, *[F.col(f"_local_{x}").bitwiseXOR(F.col(f"_before_{x}")).alias(x) for x in xor],
        (F.col("_before") + F.col("_local") - 1).cast("long").alias("rank"), F.col("size").cast("long").alias("size"))
