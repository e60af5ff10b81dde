"""The raw landing zone: JSON payloads in Parquet envelopes, one folder per day."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomledger.plans.entities import Entity
from loomledger.session import compiled_methods
from loomledger.sources.versions import subfolders

ENVELOPE = (
    "_source string, _entity string, _ingested_at timestamp_ntz, "
    "_schema_version bigint, _batch_id string, data string"
)
ENVELOPE_COLUMNS = ["_source", "_entity", "_ingested_at", "_schema_version", "_batch_id", "data"]
DAY_COLUMNS = ["year", "month", "day"]
RAW_ROOT = "raw_events"


def day_predicate(since: date | None, until: date | None) -> Column | None:
    """A predicate on the partition columns alone, so that days are pruned.

    Both bounds are inclusive.
    """
    ordinal = F.col("year") * 10000 + F.col("month") * 100 + F.col("day")
    bounds = []
    if since is not None:
        bounds.append(ordinal >= since.year * 10000 + since.month * 100 + since.day)
    if until is not None:
        bounds.append(ordinal <= until.year * 10000 + until.month * 100 + until.day)
    if not bounds:
        return None
    return bounds[0] if len(bounds) == 1 else bounds[0] & bounds[1]


def day_folders(spark: SparkSession, landing: str, since: date | None, until: date | None) -> list[str]:
    """The day folders within the bounds, found level by level: other years and months are not listed."""
    low = since or date.min
    high = until or date.max

    def within(path: str, given: tuple[int, ...]) -> list[str]:
        if len(given) == 3:
            return [path]
        size, found = len(given) + 1, []
        for folder in subfolders(spark, path):
            name, _, value = folder.rsplit("/", 1)[1].partition("=")
            if name != DAY_COLUMNS[size - 1] or not value.isdigit():
                continue
            reached = (*given, int(value))
            if low.timetuple()[:size] <= reached <= high.timetuple()[:size]:
                found += within(folder, reached)
        return found

    return within(f"{landing}/{RAW_ROOT}", ())


def read_raw_events(
    spark: SparkSession,
    landing: str,
    entity: Entity,
    since: date | None = None,
    until: date | None = None,
) -> DataFrame:
    """Scan one entity's envelopes.

    Files of other entities are skipped by name. With bounds only the day folders
    within them are listed and read. The schema is explicit: nothing is inferred,
    and a column a file lacks reads as NULL.
    """
    schema, root = f"{ENVELOPE}, year int, month int, day int", f"{landing}/{RAW_ROOT}"
    days = day_predicate(since, until)
    folders = [root] if days is None else day_folders(spark, landing, since, until)
    if not folders:
        return spark.createDataFrame([], ENVELOPE)
    events = (
        spark.read.schema(schema).option("basePath", root)
        .option("pathGlobFilter", f"raw_events_{entity.source}_{entity.name}_*.parquet").parquet(*folders)
    )
    if days is not None:
        events = events.filter(days)
    return with_payload(events).select(*ENVELOPE_COLUMNS)


def with_payload(events: DataFrame) -> DataFrame:
    """Keep events that carry a non-empty payload."""
    return events.filter(F.col("data").isNotNull() & (F.col("data") != ""))


def route(events: DataFrame, entity: Entity) -> DataFrame:
    """Keep one entity's events; both predicates reach the Parquet scan."""
    return with_payload(events).filter(
        (F.col("_source") == entity.source) & (F.col("_entity") == entity.name)
    )


def pack(rows: DataFrame, entity: Entity, payload: Sequence[Column | str]) -> DataFrame:
    """Rows -> envelopes: payload columns become one JSON text.

    NULL payload values are left out; reading a missing key gives NULL
    again. ``rows`` must carry ``_ingested_at``, ``_schema_version`` and
    ``_batch_id``; the columns of ``deal_by_day`` stay with the envelopes.
    """
    return rows.select(
        F.lit(entity.source).alias("_source"),
        F.lit(entity.name).alias("_entity"),
        "_ingested_at",
        F.col("_schema_version").cast("bigint").alias("_schema_version"),
        "_batch_id",
        F.to_json(F.struct(*payload)).alias("data"),
        *[name for name in DAY_COLUMNS if name in rows.columns],
    )


def with_day(df: DataFrame, ts: str = "_ingested_at") -> DataFrame:
    return df.withColumns({
        "year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts),
    })


def deal_by_day(rows: DataFrame, ts: str = "_ingested_at") -> DataFrame:
    """Rows dealt and sorted by ingestion day.

    Meant for rows that are still narrow: ``write_raw_events`` writes the envelopes
    packed from them as they lie, so no JSON is shuffled or sorted. The rebalance hint
    lets adaptive execution merge small days and split large ones.
    """
    return with_day(rows, ts).hint("rebalance", *DAY_COLUMNS).sortWithinPartitions(*DAY_COLUMNS)


def sort_by_day(rows: DataFrame, ts: str = "_ingested_at") -> DataFrame:
    """Rows sorted by ingestion day where they lie, for inputs of many splits: every split then writes its own file a day.

    Nothing is shuffled. The files are as many as the splits times the days, so a few rows in many
    splits should be dealt instead (``deal_by_day``).
    """
    return with_day(rows, ts).sortWithinPartitions(*DAY_COLUMNS)


def not_landed(events: DataFrame, landing: str, entity: Entity, since: date | None = None) -> DataFrame:
    """The events whose batch the landing zone does not hold yet.

    Batch ids are made distinct before the join; ``since`` bounds the days
    that are compared. Events without a batch id are always new.
    """
    try:
        landed = (
            events.sparkSession.read.schema("_batch_id string, year int, month int, day int")
            .option("pathGlobFilter", f"raw_events_{entity.source}_{entity.name}_*.parquet")
            .parquet(f"{landing}/{RAW_ROOT}")
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return events
    if not landed.inputFiles():
        return events
    days = day_predicate(since, None)
    if days is not None:
        landed = landed.filter(days)
    return events.join(landed.select("_batch_id").distinct(), "_batch_id", "left_anti").select(*events.columns)


def write_raw_events(events: DataFrame, landing: str, entity: Entity, since: date | None = None) -> None:
    """Append envelopes under their ingestion day; batches landed before are left out.

    The day folders are shared by all entities, so a rerun cannot replace
    them; it lands nothing instead. ``since`` is the first day whose batches
    may come again. The rebalance hint lets adaptive execution size the files:
    small days are merged, a day that holds most rows is split over several
    tasks. Envelopes packed from rows of ``deal_by_day`` or ``sort_by_day`` carry their day and lie so
    already, unless they had to be compared with landed batches. The file base name
    carries the entity, which is what the reader skips by. Packing a wide entity makes
    methods that the JVM would not compile, hence ``compiled_methods``.
    """
    fresh = not_landed(events, landing, entity, since)
    if fresh is not events or not set(DAY_COLUMNS) <= set(events.columns):
        fresh = with_day(fresh).hint("rebalance", *DAY_COLUMNS)
    with compiled_methods(events.sparkSession):
        (
            fresh.write.mode("append")
            .option("compression", "zstd")
            .option("mapreduce.output.basename", f"raw_events_{entity.source}_{entity.name}_batch")
            .partitionBy(*DAY_COLUMNS)
            .parquet(f"{landing}/{RAW_ROOT}")
        )
