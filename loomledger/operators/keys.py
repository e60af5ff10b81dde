"""Key-existence operators: orphan flags, key universe, broken links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """Distinct key values; one NULL survives if there is any."""
    return df.select(key).distinct()


def with_parent(child: DataFrame, parent: DataFrame, key: str, found: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """Left-join a parent that is unique on ``key`` and mark whether it was found.

    The join strategy is left to Catalyst and AQE: a parent under the
    broadcast threshold is broadcast after its size is known, a larger one
    is sort-merged with skewed child partitions split.
    """
    lookup = parent.filter(F.col(key).isNotNull()).select(key, *carry, F.lit(True).alias(found))
    return child.join(lookup, key, "left").withColumn(found, F.coalesce(F.col(found), F.lit(False)))


def missing_any(*found: str) -> Column:
    """TRUE when at least one parent is missing."""
    missing = ~F.col(found[0])
    for name in found[1:]:
        missing = missing | ~F.col(name)
    return missing


def merge_by_key(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """All keys of two inputs that are each unique on ``key``, both sides attached.

    A full outer join on the shared key: both sides are already grouped on
    it, so no shuffle is added. A NULL key never matches.
    """
    return left.join(right, key, "full_outer")


def broken_links(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose non-null key has no parent.

    Parent keys are made distinct first, which a hot key crosses once per task.
    """
    parents = parent.select(F.col(parent_key).alias("__parent_key")).distinct()
    return (
        child.filter(F.col(child_key).isNotNull())
        .join(parents, F.col(child_key) == F.col("__parent_key"), "left_anti")
    )
