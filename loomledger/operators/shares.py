"""Share-of-total without a single-partition window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def total_of(df: DataFrame, value: str) -> Column:
    """The column total as a scalar subquery (partial sums, one final row)."""
    return df.agg(F.sum(F.col(value).cast("double"))).scalar()


def with_share(df: DataFrame, value: str, name: str) -> DataFrame:
    return df.withColumn(name, F.col(value).cast("double") / total_of(df, value))
