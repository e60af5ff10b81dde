"""Edge rows through staging, business rules and marts."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from support import T0, envelopes

from loomledger.functions import columns as c
from loomledger.plans import intermediate, marts, strict
from loomledger.plans.entities import ENTITIES
from loomledger.plans.staging import stage

def staged(spark, entity, payloads):
    return {row[ENTITIES[entity].key]: row for row in stage(envelopes(spark, entity, payloads), ENTITIES[entity]).collect()}


def test_null_ids_collapse_and_newest_wins(spark):
    rows = staged(spark, "drawdowns", [
        (T0, 1, "b", {"amount": 1, "customer_id": "C"}), (T0.replace(day=12), 1, "b", {"amount": 2}),
        (T0.replace(day=11), 1, "b", {"drawdown_id": None, "amount": 3}),
        (T0, 1, "a", {"drawdown_id": "D", "amount": "12.50"}), (T0, 2, "a", {"drawdown_id": "D", "amount": "13.50"}),
        (T0, 2, "b", {"drawdown_id": "D", "amount": "14.50"}),
    ])
    assert set(rows) == {None, "D"}
    assert rows[None].amount == 2 and float(rows["D"].amount) == 14.5


def test_equal_metadata_still_gives_one_repeatable_row(spark):
    payloads = [(T0, 1, "b", {"drawdown_id": "D", "amount": n}) for n in range(20)]
    picked = {staged(spark, "drawdowns", order)["D"].amount for order in (payloads, payloads[::-1])}
    assert len(picked) == 1


def test_bad_payloads(spark):
    rows = staged(spark, "repayments", [
        (T0, 1, "b", None), (T0, 1, "b", ""), (T0, 1, "b", "not json"), (T0, 1, "b", {"repaymentId": "R9"}),
        (T0, 1, "b", {"repayment_id": "R1", "scheduled_amount": -5.0, "currency": "usd", "status": "PAID",
                      "due_date": "13/45/2026", "actual_date": "2026-01-05T10:00:00"})])
    assert set(rows) == {"R1"}
    row = rows["R1"]
    assert float(row.scheduled_amount) == -5.0 and row.currency == "USD" and row.status == "paid"
    assert row.due_date is None and row.actual_date == datetime(2026, 1, 5, 10)


def test_renamed_keys_and_cents_in_strict_mode(spark):
    raw = envelopes(spark, "invoices", [
        (T0, 1, "b", {"Invoice_ID": "I1", "customerId": "C1", "amount": 12345, "invoice_date": "01/31/2026", "status": ""}),
        (T0, 1, "b", {"invoiceId": "I2", "customer_id": "C2", "amount": "5000", "invoice_date": "31-01-2026"}),
        (T0.replace(day=11), 1, "b", {"invoice_id": "I3", "amount": 7000}),
        (T0.replace(day=11), 1, "b", {"invoice_id": "I4", "amount": 12.5})])
    rows = {row.invoice_id: row for row in strict.stage_strict(raw, ENTITIES["invoices"]).collect()}
    assert {name: float(row.amount) for name, row in rows.items()} == {"I1": 123.45, "I2": 50.0, "I3": 7000.0, "I4": 12.5}
    assert rows["I1"].customer_id == "C1" and rows["I1"].status is None
    assert rows["I1"].invoice_date == rows["I2"].invoice_date == datetime(2026, 1, 31)


def test_restaging_is_idempotent(spark):
    raw = envelopes(spark, "company_metrics", [
        (T0, 1, f"b{n}", {"metric_id": f"M{n % 3}", "headcount": str(n)}) for n in range(9)])
    once = sorted(map(tuple, stage(raw, ENTITIES["company_metrics"]).collect()))
    twice = sorted(map(tuple, stage(raw.union(raw), ENTITIES["company_metrics"]).collect()))
    assert once == twice and len(once) == 3


@pytest.fixture(scope="module")
def revenue(spark):
    subscriptions = spark.createDataFrame([
        # customer, id, mrr, currency, status, start, end
        ("steady", "S1", 100.0, "EUR", "active", datetime(2025, 11, 1), datetime(2026, 3, 1)),
        ("new", "S2", 50.0, "EUR", "active", datetime(2026, 1, 20), datetime(2026, 3, 1)),
        ("unrated", "S3", 10.0, "ISK", "active", datetime(2026, 1, 20), datetime(2026, 3, 1)),
        ("unrated", "S4", 20.0, "EUR", "active", None, datetime(2026, 3, 1)),
        ("gone", "S5", 10.0, "EUR", "cancelled", datetime(2025, 11, 1), datetime(2026, 3, 1)),
        ("zero", "S6", 0.0, "EUR", "active", datetime(2025, 11, 1), datetime(2026, 3, 1)),
        (None, "S7", 70.0, "EUR", "active", datetime(2025, 11, 1), datetime(2026, 3, 1)),
        ("foreign", "S8", 10.0, "GBP", "active", datetime(2025, 11, 1), datetime(2026, 3, 1)),
    ], "customer_id string, subscription_id string, mrr double, currency string, status string, "
       "billing_period_start timestamp_ntz, billing_period_end timestamp_ntz").withColumns({
           "mrr_amount": F.col("mrr").cast(c.MONEY), "created_at": F.col("billing_period_start")})
    fx = spark.createDataFrame([
        ("T1", "GBP", "EUR", 1.1, datetime(2026, 1, 1)), ("T2", "GBP", "EUR", 1.2, datetime(2026, 1, 2)),
        ("T3", "GBP", "EUR", -1.0, datetime(2026, 1, 3)), ("T4", "GBP", "USD", 9.0, datetime(2026, 1, 4))],
        "transaction_id string, base_currency string, quote_currency string, rate double, transaction_date timestamp_ntz")
    return {row.customer_id: row for row in intermediate.arr_per_customer(
        subscriptions, fx, c.ntz("2026-02-01 00:00:00")).collect()}


def test_recurring_revenue(revenue):
    assert revenue["steady"].current_arr == 1200 and revenue["steady"].arr_growth_pct == 0
    assert revenue["new"].current_arr == 600 and revenue["new"].arr_growth_pct == 0
    assert revenue["foreign"].current_arr == pytest.approx(144)
    # An unrated subscription counts but adds nothing; the dated one is the earliest.
    assert revenue["unrated"].subscription_count == 2 and revenue["unrated"].current_arr == 240
    assert revenue["unrated"].arr_growth_pct is None
    assert revenue["gone"].current_arr == 0 and revenue["gone"].arr_growth_pct is None
    assert revenue["zero"].arr_growth_pct is None
    assert revenue[None].current_arr == 0 and revenue[None].subscription_count == 0


def test_facility_positions(spark):
    facilities = spark.createDataFrame(
        [("F1", "C1", 100.0, "active"), ("F0", "C1", 0.0, "active"), ("FN", "C1", None, "active")],
        "facility_id string, customer_id string, lim double, status string").withColumns({
            "facility_limit": F.col("lim").cast(c.MONEY), "currency": F.lit("EUR")})
    drawdowns = spark.createDataFrame(
        [("F1", 30.0, "completed"), ("F1", 10.0, "pending"), ("F9", 5.0, "completed"), (None, 7.0, "completed"),
         (None, 8.0, "completed"), ("F0", 1.0, "completed")],
        "facility_id string, a double, status string").withColumn("amount", F.col("a").cast(c.MONEY))
    rows = {r.facility_id: r for r in intermediate.facility_utilization(facilities, drawdowns).collect()}
    assert set(rows) == {"F1", "F0", "FN", "F9", None}
    assert rows["F1"].current_utilization_pct == 30 and not rows["F1"].is_orphaned
    assert rows["F0"].current_utilization_pct is None and rows["FN"].current_utilization_pct is None
    assert rows["F9"].is_orphaned and float(rows["F9"].total_drawn_amount) == 5
    assert rows[None].is_orphaned and float(rows[None].total_drawn_amount) == 0


def test_schedules(spark):
    texts = [None, "", "[]", '[{"due_date": "2026-01-01", "amount": 5}]',
             '[{"due_date": "2026-01-01"}, {"due_date": "2026-02-01", "amount": 7.125}]']
    facilities = spark.createDataFrame([(f"F{i}", "C", "EUR", text) for i, text in enumerate(texts)],
                                       "facility_id string, customer_id string, currency string, repayment_schedule_json string")
    rows = [(r.facility_id, str(r.installment_due_date), None if r.installment_amount is None else float(r.installment_amount))
            for r in intermediate.repayment_schedule(facilities).collect()]
    assert sorted(rows, key=str) == [("F3", "2026-01-01", 5.0), ("F4", "2026-01-01", None), ("F4", "2026-02-01", 7.125)]


def test_strict_schedule_fails_on_bad_dates_and_lenient_does_not(spark):
    bad = spark.createDataFrame([("F", "C", "EUR", '[{"due_date": "soon", "amount": 1}]')],
                                "facility_id string, customer_id string, currency string, repayment_schedule_json string")
    with pytest.raises(Exception):
        intermediate.repayment_schedule(bad).collect()
    assert intermediate.repayment_schedule(bad, strict=False).first().installment_due_date is None


def test_latest_application_and_growth(spark):
    applications = spark.createDataFrame(
        [("A1", "C1", "approved", datetime(2025, 1, 1), "old"), ("A2", "C1", "rejected", datetime(2025, 6, 1), "later"),
         ("A3", "C1", "approved", None, "undated"), ("A4", "C2", "pending", datetime(2025, 1, 1), "never")],
        "application_id string, customer_id string, status string, application_date timestamp_ntz, company_name string"
    ).withColumns({name: F.lit(None).cast("string") for name in ("country_code", "industry")} | {
        "headcount_at_application": F.lit(1).cast("bigint"), "valuation_at_application": F.lit(1).cast(c.MONEY),
        "arr_at_application": F.lit(1).cast(c.MONEY)})
    [row] = marts.latest_application(applications).collect()
    assert (row.customer_id, row.company_name) == ("C1", "old")

    metrics = spark.createDataFrame(
        [("M1", "C1", datetime(2025, 1, 1), 0, 5.0), ("M2", "C1", datetime(2025, 2, 1), 9, 6.0),
         ("M3", "C2", datetime(2025, 2, 1), 4, 8.0)],
        "metric_id string, customer_id string, metric_date timestamp_ntz, headcount bigint, v double").withColumns({
            "valuation": F.col("v").cast(c.MONEY), "arr_reported": F.col("v").cast(c.MONEY)})
    pairs = {r.customer_id: r for r in marts.metric_snapshots(metrics).collect()}
    assert (pairs["C1"].current_headcount, pairs["C1"].prior_headcount) == (9, 0)
    assert pairs["C2"].prior_headcount is None


def test_primary_currency_ties_and_null(spark):
    balances = spark.createDataFrame(
        [("C1", "EUR", 5.0), ("C1", "DKK", 5.0), ("C2", None, 9.0), ("C2", "EUR", 1.0)],
        "customer_id string, currency string, balance double")
    assert {r.customer_id: r.primary_account_currency for r in marts.primary_currency(balances).collect()} == {
        "C1": "DKK", "C2": None}
