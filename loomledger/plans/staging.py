"""Raw envelopes -> typed, cleansed, latest-wins staging rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomledger.functions import columns as c
from loomledger.operators.latest import latest_version
from loomledger.plans.entities import Entity
from loomledger.sources.envelope import route

METADATA = ["_ingested_at", "_schema_version"]


def parsed(raw: DataFrame, entity: Entity) -> DataFrame:
    """Payload keys as text columns, plus what latest-wins orders by.

    Malformed payloads come along, marked, and leave with the ranking: a filter
    here would be pushed to the scan and parse every payload again.
    """
    return (
        _opened(raw, entity)
        .select("_payload.*", *METADATA, "_batch_id", F.xxhash64("data").alias("_payload_hash"))
    )


def _opened(raw: DataFrame, entity: Entity) -> DataFrame:
    return route(raw, entity).withColumn("_payload", c.json_struct(F.col("data"), entity.columns))


def quarantined(raw: DataFrame, entity: Entity) -> DataFrame:
    """Events of one entity whose payload is not valid JSON; staging leaves exactly these out."""
    return (_opened(raw, entity).filter(F.col(f"_payload.{c.MALFORMED}").isNotNull())
            .select(F.lit(entity.source).alias("source"), F.lit(entity.name).alias("entity"), *METADATA, "_batch_id", "data"))


def malformed_counts(raw: DataFrame, entity: Entity) -> DataFrame:
    """Quarantined events per entity and ingestion day."""
    return (quarantined(raw, entity).groupBy("source", "entity", F.to_date("_ingested_at").alias("day"))
            .agg(F.count(F.lit(1)).alias("malformed")))


def cleansed(text_rows: DataFrame, entity: Entity) -> DataFrame:
    """Text columns -> typed columns."""
    typed = [cleanse(F.col(name)).alias(name) for name, cleanse in entity.columns.items()]
    marks = [c.MALFORMED] if c.MALFORMED in text_rows.columns else []
    return text_rows.select(*typed, *METADATA, "_batch_id", "_payload_hash", *marks)


def stage(raw: DataFrame, entity: Entity) -> DataFrame:
    """The staging relation of one entity: one row per key."""
    rows = latest_version(cleansed(parsed(raw, entity), entity), entity.key, not entity.key_required)
    return rows.select(*entity.columns, *METADATA)


def newest_ingestion(raw: DataFrame, entity: Entity) -> DataFrame:
    """One row: the newest ingestion time among keyed rows.

    Latest-wins keeps the newest row of every key, so this equals the
    maximum over the staged rows without deduplicating first.
    """
    key = c.json_text(F.col("data"), entity.key)
    return route(raw, entity).filter(key.isNotNull()).agg(F.max("_ingested_at").alias("newest"))
