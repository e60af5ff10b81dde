"""Generated data: repeatable, consistent keys, dirt at its stated rates."""

import pytest
from pyspark.sql import functions as F

from loomledger.generate import entities as g
from loomledger.generate import rates as rt
from loomledger.generate.dirt import generate, land
from loomledger.plans.entities import ENTITIES
from loomledger.plans.warehouse import Warehouse
from loomledger.sources.envelope import read_raw_events

PLAN = g.Plan(seed=7)


@pytest.fixture(scope="module")
def master(spark):
    return g.customers(spark.range(600), "id", PLAN).cache()


def share(df, condition):
    row = df.agg(F.avg(F.when(F.expr(condition), 1.0).otherwise(0.0)).alias("p")).first()
    return row.p


def test_customers(master):
    markets = {r.country_code: r["count"] for r in master.groupBy("country_code").count().collect()}
    assert len(markets) == 15 and min(markets.values()) >= 2 and max(markets.values()) <= 120
    segments = {r.segment: r["count"] / 600 for r in master.groupBy("segment").count().collect()}
    for name, expected in (("seed", 0.25), ("growth", 0.55), ("scale", 0.20)):
        assert segments[name] == pytest.approx(expected, abs=0.06)
    assert master.filter("target_limit > 0.7 * target_arr").count() == 0


def test_rows_do_not_depend_on_partitioning(spark, master):
    again = g.customers(spark.range(600).repartition(13), "id", PLAN)
    for name in ("subscriptions", "drawdowns", "fx_transactions"):
        one, two = g.GENERATORS[name](master, PLAN), g.GENERATORS[name](again, PLAN)
        assert one.exceptAll(two).count() == 0 and one.count() == two.count()


def test_keys_fit_together(master):
    facilities = g.credit_facilities(master, PLAN)
    drawdowns = g.drawdowns(master, PLAN)
    missing = drawdowns.join(facilities, "facility_id", "left_anti").count() / drawdowns.count()
    assert missing == pytest.approx(0.05, abs=0.02)
    subscriptions, invoices = g.subscriptions(master, PLAN), g.invoices(master, PLAN)
    assert invoices.filter("subscription_id IS NOT NULL").join(subscriptions, "subscription_id", "left_anti").count() == 0
    assert share(invoices, "subscription_id IS NOT NULL") == pytest.approx(0.80, abs=0.02)


def test_value_rates(master):
    drawdowns = g.drawdowns(master, PLAN)
    assert share(drawdowns, "drawdown_id IS NULL") == pytest.approx(0.02, abs=0.015)
    assert share(drawdowns, "amount < 0") == pytest.approx(0.03, abs=0.015)
    bad = ", ".join(f"'{x}'" for x in rt.BAD_CURRENCIES)
    assert share(g.subscriptions(master, PLAN), f"currency IN ({bad})") == pytest.approx(0.08, abs=0.02)
    fx = g.fx_transactions(master, PLAN)
    assert share(fx, "quote_amount IS NULL") == pytest.approx(0.30, abs=0.03)
    assert fx.filter("rate <= 0").count() == 0
    assert share(g.subscriptions(master, PLAN), "status = 'active'") == pytest.approx(0.92, abs=0.02)
    assert share(g.repayments(master, PLAN), "status = 'paid'") == pytest.approx(0.83, abs=0.03)


def test_dirt_varies_by_batch_and_stale_rows_move_back(master):
    events = generate(master, "subscriptions", PLAN)
    renamed = events.groupBy(F.to_date("_ingested_at").alias("day")).agg(
        F.countDistinct(F.expr("data LIKE '%\"customerId\"%' OR data LIKE '%\"Customer_ID\"%'")).alias("kinds"))
    fresh = renamed.filter("day >= '2026-01-01'")
    assert fresh.filter("kinds > 1").count() == 0
    assert share(events, "_ingested_at < timestamp_ntz'2026-01-01 00:00:00'") == pytest.approx(0.05, abs=0.01)
    dates = events.select(F.get_json_object("data", "$.billing_period_start").alias("t"))
    assert share(dates, r"t RLIKE '^\\d{10}$'") == pytest.approx(0.028, abs=0.01)


def test_generated_landing_builds_the_whole_warehouse(spark, tmp_path):
    few = g.customers(spark.range(60), "id", PLAN)
    land(spark, few, PLAN, str(tmp_path))
    warehouse = Warehouse(spark, lambda name: read_raw_events(spark, str(tmp_path), ENTITIES[name]))
    assert 0 < warehouse.dim_customers().count() <= 61
    assert warehouse.fct_repayments().filter("is_orphaned").count() > 0
    assert warehouse.fct_repayments().count() == warehouse.staged("repayments").count()
