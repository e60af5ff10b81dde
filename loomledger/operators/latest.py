"""Pick rows by rank within a key.

Every pick is ``row_number() <= k`` so that Catalyst plans a partial
``WindowGroupLimit`` below the shuffle: each task forwards at most k rows
per key, and a key holding a third of all rows (or the NULL key) shrinks
to k rows per task before anything moves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomledger.functions.columns import MALFORMED

_RANK = "__rank"


def rank_within(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first k rows per key, with their rank in ``__rank``."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) <= k)


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key. ``order`` should end in a unique column."""
    return rank_within(df, keys, order, 1).drop(_RANK)


def latest_version(df: DataFrame, key: str, keep_null_key: bool = False) -> DataFrame:
    """Latest-wins per key: newest ingestion, then schema version.

    Batch id and payload hash complete the order, so re-runs and retried
    tasks keep the same row. Rows without a key count as one key, which is
    dropped unless ``keep_null_key``.
    """
    order = [F.desc_nulls_last(c) for c in ("_ingested_at", "_schema_version", "_batch_id", "_payload_hash")]
    if MALFORMED in df.columns:
        # Rows whose payload does not parse rank behind all others and then go, tied to the rank as below.
        malformed = F.col(MALFORMED).isNotNull().cast("int")
        ranked = rank_within(df, [key], [malformed.asc(), *order], 1)
        ranked = ranked.filter(F.col(_RANK) + malformed == 1).drop(MALFORMED)
    else:
        ranked = rank_within(df, [key], order, 1)
    if not keep_null_key:
        # Tied to the rank on purpose: a plain IS NOT NULL would be pushed down
        # to the scan and parse every payload a second time. The limit above has
        # already cut the NULL key to one row per task.
        ranked = ranked.filter(F.col(_RANK) + F.col(key).isNull().cast("int") == 1)
    return ranked.drop(_RANK)


def latest_and_prior(df: DataFrame, key: str, order: Sequence[Column],
                     latest: dict[str, str], prior: dict[str, str]) -> DataFrame:
    """Newest and second-newest row per key side by side, in one window pass.

    ``latest`` and ``prior`` map source column -> output column.
    """
    ranked = rank_within(df, [key], order, 2)

    def take(rank: int, source: str, name: str) -> Column:
        return F.max(F.when(F.col(_RANK) == rank, F.col(source))).alias(name)

    return ranked.groupBy(key).agg(
        *[take(1, source, name) for source, name in latest.items()],
        *[take(2, source, name) for source, name in prior.items()],
    )


def earliest_value(value: Column, order: Sequence[Column]) -> Column:
    """Aggregate: the value at the smallest ``order``, NULLs sorted last."""
    parts: list[Column] = []
    for column in order:
        parts += [column.isNull(), column]
    return F.min_by(F.struct(value.alias("v")), F.struct(*parts))["v"]
