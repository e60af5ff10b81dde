"""Staging and rules in the strict reading of the written specification.

The default jobs reproduce what the models do; these recover renamed keys,
other date formats, minor units and inverted rates as well.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomledger.functions import columns as c
from loomledger.functions import strict as st
from loomledger.operators.latest import latest_version
from loomledger.plans import units
from loomledger.plans.entities import Entity
from loomledger.plans.intermediate import completed_draws
from loomledger.plans.staging import METADATA, cleansed
from loomledger.plans.units import written
from loomledger.sources.envelope import route


def parsed_any_case(raw: DataFrame, entity: Entity, marked: bool = False) -> DataFrame:
    """Payload keys as text columns, matched after snake-casing them.

    The exact spelling wins when a payload carries both. With ``marked``, a payload
    that is not a JSON object is kept whole in the column that staging ranks last.
    """
    keyed = (
        route(raw, entity)
        .withColumn("_map", F.from_json("data", "map<string,string>"))
        .withColumn("_names", F.transform(F.map_keys("_map"), st.snake_case))
        .withColumn("_values", F.map_values("_map"))
    )

    def field(name: str) -> Column:
        by_case = F.get("_values", (F.array_position("_names", name) - 1).cast("int"))
        return F.coalesce(F.try_element_at("_map", F.lit(name)), by_case).alias(name)

    mark = [F.when(F.col("_map").isNull(), F.col("data")).alias(c.MALFORMED)] if marked else []
    return keyed.select(
        *[field(name) for name in entity.columns], *METADATA, "_batch_id", F.xxhash64("data").alias("_payload_hash"), *mark)


def parsed_once(raw: DataFrame, entity: Entity) -> DataFrame:
    """``parsed_any_case`` with malformed payloads marked and blanks as NULL, written once for all that follows."""
    rows = parsed_any_case(raw, entity, marked=True)
    return written(blanks_to_null(rows, entity), f"strict-{entity.name}")


def blanks_to_null(text_rows: DataFrame, entity: Entity) -> DataFrame:
    return text_rows.withColumns({name: c.blank_to_null(F.col(name)) for name in entity.columns})


#: A day needs so many amounts before their all being whole counts as evidence.
MIN_EVIDENCE = 2


def minor_unit_days(text_rows: DataFrame, entity: Entity, min_evidence: int = MIN_EVIDENCE) -> DataFrame:
    """Per ingestion day, which fractional amounts came as whole numbers only.

    One value says nothing, so the decision is taken per day, and only where it
    has ``min_evidence`` values; other days keep their amounts. One row per day,
    aggregated map-side.
    """
    def whole(name: str) -> Column:
        seen = F.count(F.col(name)) >= min_evidence
        return F.coalesce(seen & F.bool_and(st.is_whole_text(F.col(name))), F.lit(False)).alias(f"_minor_{name}")

    return text_rows.groupBy(F.to_date("_ingested_at").alias("_day")).agg(*[whole(n) for n in entity.fractional])


def to_major_units(text_rows: DataFrame, entity: Entity) -> DataFrame:
    """Divide the amounts of minor-unit batches by 100."""
    if not entity.fractional:
        return text_rows
    dated = text_rows.withColumn("_day", F.to_date("_ingested_at"))
    # One row per calendar day at most: a century of days is about a megabyte.
    flagged = dated.join(F.broadcast(minor_unit_days(text_rows, entity)), "_day", "left")
    scaled = {
        name: F.when(F.col(f"_minor_{name}"), (c.to_number(F.col(name)) / 100.0).cast("string")).otherwise(F.col(name))
        for name in entity.fractional
    }
    return flagged.withColumns(scaled).drop("_day", *[f"_minor_{name}" for name in entity.fractional])


def with_any_dates(entity: Entity) -> Entity:
    cleansers = {
        name: st.parse_any_date if name in entity.dates else cleanse for name, cleanse in entity.columns.items()
    }
    if "risk_rating" in cleansers:
        cleansers["risk_rating"] = st.risk_rating
    return replace(entity, columns=cleansers)


def stage_strict(raw: DataFrame, entity: Entity) -> DataFrame:
    """Like the default staging, with all recoveries switched on."""
    text_rows = blanks_to_null(parsed_any_case(raw, entity), entity)
    rows = cleansed(to_major_units(text_rows, entity), with_any_dates(entity))
    return latest_version(rows, entity.key, not entity.key_required).select(*entity.columns, *METADATA)


def stage_recovered(raw: DataFrame, entity: Entity) -> DataFrame:
    """The staging relation with all recoveries: one scan and one parse of the raw events.

    The parsed rows are written; units are inferred from them batch by batch
    (``units``) and the rows are read back once more. Inverted exchange rates are turned.
    """
    rows = cleansed(units.to_major_units(parsed_once(raw, entity), entity), with_any_dates(entity))
    staged = latest_version(rows, entity.key, not entity.key_required).select(*entity.columns, *METADATA)
    if "rate" not in entity.columns:
        return staged
    # Written, as the rates of a pair are first summed up and then held against their typical value.
    turned = direct_rates(written(staged, f"strict-{entity.name}"))
    return turned.withColumn("rate", F.col("effective_rate")).select(*entity.columns, *METADATA)


def direct_rates(fx_transactions: DataFrame) -> DataFrame:
    """Transactions with inverted rates turned round.

    The typical rate of a pair is an approximate median: its state is
    bounded, however many rows one pair holds. Pairs come from two code
    lists, so the lookup side has a fixed size and may be broadcast.
    """
    pair = ["base_currency", "quote_currency"]
    usable = fx_transactions.filter((F.col("rate") > 0) & F.col(pair[0]).isNotNull() & F.col(pair[1]).isNotNull())
    typical = usable.groupBy(*pair).agg(F.percentile_approx("rate", 0.5, 1000).alias("typical"))
    joined = fx_transactions.join(F.broadcast(typical), pair, "left")
    rate = F.when(F.col("typical").isNull(), F.col("rate")).otherwise(st.direct_rate(F.col("rate"), F.col("typical")))
    return joined.withColumn("effective_rate", rate).drop("typical")


def growth_since_application(customers: DataFrame) -> DataFrame:
    """Team growth and valuation multiple against the application baseline."""
    headcount, at_application = F.col("current_headcount"), F.col("headcount_at_application")
    return customers.select(
        "customer_id",
        c.ratio(headcount - at_application, at_application, 100).alias("team_growth_pct"),
        c.ratio(F.col("current_valuation"), F.col("valuation_at_application")).alias("valuation_increase_multiple"))


def customer_utilisation(facilities: DataFrame, drawdowns: DataFrame) -> DataFrame:
    """Drawn over limit per customer, active facilities only."""
    active = facilities.filter(F.col("status") == "active").select("facility_id", "customer_id", "facility_limit")
    per_facility = active.join(completed_draws(drawdowns, "facility_id"), "facility_id", "left")
    totals = per_facility.groupBy("customer_id").agg(
        c.money_sum(F.coalesce("total_drawn_amount", F.lit(0).cast(c.MONEY_SUM))).alias("total_drawn_amount"),
        c.money_sum(F.col("facility_limit")).alias("total_facility_limit"))
    return totals.withColumn(
        "utilisation_pct", c.ratio(F.col("total_drawn_amount"), F.col("total_facility_limit")) * 100.0)
