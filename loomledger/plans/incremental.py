"""Latest-wins staging kept up to date: only new events are parsed, only the key buckets they touch are rewritten.

The state of an entity is its staging relation with what latest-wins orders by, one
row per key, in buckets of the key's hash. Merging keeps the newer of the held and the
fresh row of each key. As that order is total, the state equals a full rescan whatever
the events were split into, however late or back-dated they came, and however often a
batch is merged again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomledger.operators.latest import first_by, latest_version
from loomledger.plans.entities import ENTITIES, Entity
from loomledger.plans.staging import METADATA, cleansed, parsed
from loomledger.plans.warehouse import Warehouse
from loomledger.sources.envelope import ENVELOPE, ENVELOPE_COLUMNS, RAW_ROOT, with_payload
from loomledger.sources.versions import BUCKET, Buckets

ORDER = ["_ingested_at", "_schema_version", "_batch_id", "_payload_hash"]


def ordered_stage(raw: DataFrame, entity: Entity) -> DataFrame:
    """The staging rows of some events, with all that latest-wins orders by."""
    rows = latest_version(cleansed(parsed(raw, entity), entity), entity.key, not entity.key_required)
    return rows.select(*entity.columns, *ORDER)


def bucket_of(key: str, n_buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(n_buckets)).cast("int")


def state_schema(spark: SparkSession, entity: Entity) -> T.StructType:
    return ordered_stage(spark.createDataFrame([], ENVELOPE), entity).schema


class StagingState:
    """The written staging relation of one entity under ``root``.

    ``n_buckets`` is fixed by the first merge; a bucket is what one task rewrites, so a
    table of a terabyte asks for about a thousand.
    """

    def __init__(self, spark: SparkSession, root: str, entity: Entity, n_buckets: int = 64):
        self.spark, self.entity, self.root = spark, entity, root
        self.buckets = Buckets(spark, root, n_buckets)
        self.schema = state_schema(spark, entity)

    def read(self) -> DataFrame:
        """The staging relation, as ``stage`` gives it for all merged events."""
        return self.buckets.read(self.schema).select(*self.entity.columns, *METADATA)

    def merge(self, raw: DataFrame) -> list[int]:
        """Merge some events; returns the buckets that were rewritten.

        Events are reduced to the newest per key before they meet the state, so
        no key has more than two rows in the merge.
        """
        self.buckets.refresh()
        fresh = ordered_stage(raw, self.entity).withColumn(BUCKET, bucket_of(self.entity.key, self.buckets.n_buckets))
        incoming = f"{self.root}/incoming/{self.buckets.number:012d}"
        fresh.write.mode("overwrite").option("compression", "zstd").parquet(incoming)
        fresh = self.spark.read.schema(fresh.schema).parquet(incoming)
        touched = sorted(row[0] for row in fresh.select(BUCKET).distinct().collect())
        if touched:
            self.buckets.replace(self.merged(fresh, touched), touched)
        return touched

    def merged(self, fresh: DataFrame, touched: list[int]) -> DataFrame:
        """The new rows of the touched buckets; one shuffle, by bucket."""
        held = self.buckets.read(self.schema, touched).withColumn(BUCKET, bucket_of(self.entity.key, self.buckets.n_buckets))
        both = held.unionByName(fresh).repartition(BUCKET)
        return first_by(both, [BUCKET, self.entity.key], [F.desc_nulls_last(name) for name in ORDER])

    def follow(self, landing: str, files_at_once: int | None = None) -> None:
        """Merge every file that was landed since the last call, in whichever day folder it lies.

        A stream over the landing zone remembers the files it has seen; a batch that
        is repeated after a crash changes nothing.
        """
        name = f"raw_events_{self.entity.source}_{self.entity.name}_*.parquet"
        reader = (self.spark.readStream.schema(f"{ENVELOPE}, year int, month int, day int").option("pathGlobFilter", name))
        if files_at_once:
            reader = reader.option("maxFilesPerTrigger", files_at_once)
        events = with_payload(reader.parquet(f"{landing}/{RAW_ROOT}")).select(*ENVELOPE_COLUMNS)
        (events.writeStream.foreachBatch(lambda batch, _: self.merge(batch) and None)
         .option("checkpointLocation", f"{self.root}/progress").trigger(availableNow=True).start().awaitTermination())


def incremental_warehouse(spark: SparkSession, states: dict[str, StagingState], now: Column | None = None) -> Warehouse:
    """All models over the staging states of the named entities."""
    def absent(entity: str) -> DataFrame:
        raise KeyError(f"no staging state for {entity}")

    return Warehouse(spark, absent, now, {ENTITIES[name].table: state.read() for name, state in states.items()})
