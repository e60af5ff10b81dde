"""Dirt of generated batches, and packing them into raw events.

Value dirt varies per row. Key names, extra keys and amount types vary per
(ingestion day, entity), so a whole daily batch looks alike. Days are keyed
by their date; no ordering over days is computed.

Each decision costs one draw, put into a column of its own first and only
then compared, so it is hashed once however often it is looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomledger.functions.draws import Draws
from loomledger.generate import rates as rt
from loomledger.generate.entities import GENERATORS, Deal, Plan
from loomledger.plans.entities import ENTITIES, Entity
from loomledger.sources.envelope import DAY_COLUMNS, ENVELOPE_COLUMNS, deal_by_day, write_raw_events


def part_of(u: Column, low: float, high: float, count: int) -> Column:
    """0..count-1, for a draw known to lie in [low, high)."""
    return F.least(F.floor((u - low) / (high - low) * count), F.lit(count - 1))


def one_of(values: list[Column], index: Column) -> Column:
    return F.element_at(F.array(*values), (index + 1).cast("int"))


def dirty_date(ts: Column, u: Column) -> Column:
    """1 % impossible, 6 % another format, 3 % epoch, 2 % US, else ISO."""
    impossible = rt.IMPOSSIBLE_DATE_RATE
    dirty = impossible + (1 - impossible) * rt.DIRTY_DATE_RATE
    epoch = dirty + (1 - dirty) * rt.EPOCH_DATE_RATE
    us = epoch + (1 - epoch) * rt.US_DATE_RATE
    broken = F.concat_ws(
        "/", part_of(u, 0.0, impossible, 11) + 13, part_of(u, 0.0, impossible, 14) + 32, F.year(ts))
    formatted = one_of([F.date_format(ts, form) for form in rt.DIRTY_DATE_FORMATS],
                       part_of(u, impossible, dirty, len(rt.DIRTY_DATE_FORMATS)))
    seconds = F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), ts).cast("string")
    text = (
        F.when(u < impossible, broken).when(u < dirty, formatted).when(u < epoch, seconds)
        .when(u < us, F.date_format(ts, "MM/dd/yyyy")).otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
    )
    return F.when(ts.isNotNull(), text)


def drifting_amount(value: Column, u: Column) -> Column:
    """In 15 % of batches the column is text cents, text major units or whole cents."""
    drifts = u < rt.TYPE_DRIFT_RATE
    mode = part_of(u, 0.0, rt.TYPE_DRIFT_RATE, 3)
    major = value.cast("double")
    minor = (F.floor(F.abs(major) * 100) * F.signum(major)).cast("bigint")
    return (
        F.when(drifts & (mode == 0), minor.cast("string").cast("variant"))
        .when(drifts & (mode == 1), major.cast("string").cast("variant"))
        .when(drifts & (mode == 2), minor.cast("variant"))
        .otherwise(value.cast("variant"))
    )


def spelled(value: Column, name: str, u: Column) -> list[Column]:
    """The value under the key this batch uses; the other spellings stay NULL
    and are left out of the JSON."""
    variants = rt.KEY_VARIANTS[name]
    which = part_of(u, 0.0, rt.RENAME_RATE, len(variants))
    renamed = u < rt.RENAME_RATE
    return [F.when(~renamed, value).alias(name)] + [
        F.when(renamed & (which == i), value).alias(variant) for i, variant in enumerate(variants)]


def drift_key(entity: Entity) -> str | None:
    """The key that batches of an entity may carry or lack."""
    return {"credit_facilities": "collateral_required", "loan_applications": "referral_source",
            "fx_transactions": "counterparty_bank_bic"}.get(entity.name)


def drift_value(name: str, u: Column) -> Column:
    if name == "collateral_required":
        return F.when(u < rt.COLLATERAL_RATE, u < rt.COLLATERAL_RATE / 2)
    if name == "referral_source":
        source = one_of([F.lit(w) for w in ("partner", "web", "event", "broker")], part_of(u, 0.0, rt.REFERRAL_RATE, 4))
        return F.when(u < rt.REFERRAL_RATE, source)
    return F.when(u >= rt.BIC_DROP_RATE, F.col(name))


def landing_time(ingested: Column, late: Column) -> Column:
    """When a row lands: some are backdated, like a partition that lands late."""
    days = F.when(late < rt.STALE_RATE, part_of(late, 0.0, rt.STALE_RATE, rt.STALE_JITTER + 1) + rt.STALE_DAYS)
    return ingested - F.make_dt_interval(F.coalesce(days, F.lit(0)).cast("int"))


def row_draws(entity: Entity, plan: Plan, key: Column, ingested: Column, created: Column) -> Draws:
    """Ids may be NULL, so the row's times take part in its key."""
    return plan.draws(f"row {entity.name}", key, ingested, created)


def dealt_by_landing_day(entity: Entity, plan: Plan) -> Deal:
    """Deals rows by the day they will land on, before their values and their JSON are computed."""
    def deal(rows: DataFrame, key: Column, ingested: Column, created: Column) -> DataFrame:
        late = row_draws(entity, plan, key, ingested, created).uniform("late")
        # The draw stands in a column of its own, below the days that look at it.
        landed = rows.withColumn("_late", late).withColumn("_landed_at", landing_time(ingested, F.col("_late")))
        return deal_by_day(landed, "_landed_at").drop("_late", "_landed_at")
    return deal


def dirty_events(rows: DataFrame, entity: Entity, plan: Plan) -> DataFrame:
    """Typed rows -> dirty raw events; a day's columns stay with them."""
    batch = plan.draws(f"batch {entity.name}", F.to_date("_ingested_at"))
    row = row_draws(entity, plan, F.col(entity.key), F.col("_ingested_at"), F.col("created_at"))
    dealt = [name for name in DAY_COLUMNS if name in rows.columns]
    drift = drift_key(entity)
    names = [name for name in rows.columns if name not in ("_ingested_at", drift, *dealt)]
    dates = [name for name in names if name in entity.dates or name == "created_at"]
    amounts = [name for name in names if name in entity.amounts]

    draws = {f"_form_{name}": row.uniform(f"{name}/form") for name in dates}
    draws |= {f"_type_{name}": batch.uniform(f"{name}/type") for name in amounts}
    draws |= {f"_key_{name}": batch.uniform(f"{name}/key") for name in names if name in rt.KEY_VARIANTS}
    draws |= {"_drift": batch.uniform("drift"), "_late": row.uniform("late"), "_tag": F.substring(row.digest("tag"), 1, 16)}
    drawn = rows.withColumns(draws)

    payload: list[Column] = []
    for name in names:
        value = F.col(name)
        if name in dates:
            value = dirty_date(value, F.col(f"_form_{name}"))
        elif name in amounts:
            value = drifting_amount(value, F.col(f"_type_{name}"))
        payload += spelled(value, name, F.col(f"_key_{name}")) if name in rt.KEY_VARIANTS else [value.alias(name)]
    if drift:
        payload.append(drift_value(drift, F.col("_drift")).alias(drift))

    # Backdated after the batch decisions.
    landed_at = landing_time(F.col("_ingested_at"), F.col("_late"))
    return drawn.select(F.to_json(F.struct(*payload)).alias("data"), landed_at.alias("_ingested_at"), "_tag", *dealt).select(
        F.lit(entity.source).alias("_source"), F.lit(entity.name).alias("_entity"), "_ingested_at",
        F.lit(1).cast("bigint").alias("_schema_version"),
        F.concat_ws("_", F.lit(f"{entity.source}_{entity.name}"), F.date_format("_ingested_at", "yyyy-MM-dd"), "_tag")
        .alias("_batch_id"),
        "data", *dealt,
    ).select(*ENVELOPE_COLUMNS, *dealt)


def generate(master: DataFrame, name: str, plan: Plan, by_day: bool = False) -> DataFrame:
    """Dirty raw events of one entity for the customers in ``master``; ``by_day`` for ``write_raw_events``."""
    if not by_day:
        return dirty_events(GENERATORS[name](master, plan), ENTITIES[name], plan)
    return dirty_events(GENERATORS[name](master, plan, dealt_by_landing_day(ENTITIES[name], plan)), ENTITIES[name], plan)


def land(spark: SparkSession, master: DataFrame, plan: Plan, landing: str) -> None:
    """Generate all nine entities into a landing folder."""
    for name, entity in ENTITIES.items():
        write_raw_events(generate(master, name, plan, by_day=True), landing, entity)
