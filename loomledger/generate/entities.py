"""Rows of the nine entities for any number of customers.

Every function maps customers to rows with ``explode`` over a bounded count
per customer; children recompute their parents' ids from the same draws, so
no join and no shuffle is needed to keep foreign keys consistent. ``deal`` gets
the exploded rows before their values are computed; a day's columns that it adds
stay with the rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomledger.functions.draws import Draws, cents
from loomledger.generate import rates as rt
from loomledger.sources.envelope import DAY_COLUMNS

#: Puts rows that are still narrow where they will be written, given the expressions of a row's key, ingestion
#: time and creation time (``dirt.dealt_by_landing_day``).
Deal = Callable[[DataFrame, Column, Column, Column], DataFrame]


@dataclass(frozen=True)
class Plan:
    """What to generate: seed and the window of ingestion days."""

    seed: int = 42
    start: str = "2026-01-01"
    days: int = 30

    @property
    def first_day(self) -> Column:
        return F.lit(self.start).cast("timestamp_ntz")

    def draws(self, kind: str, *key: Column) -> Draws:
        return Draws(self.seed, kind, *key)


def after(ts: Column, days: Column) -> Column:
    return ts + F.make_dt_interval(days.cast("int"))


def _by_segment(index: int, part: int) -> Column:
    ladder = None
    for name, spec in rt.SEGMENTS.items():
        value = F.lit(spec[index][part])
        ladder = F.when(F.col("segment") == name, value) if ladder is None else ladder.when(F.col("segment") == name, value)
    return ladder


def _market(index: Column, part: int) -> Column:
    return F.element_at(F.array(*[F.lit(m[part]) for m in rt.MARKETS]), (index + 1).cast("int"))


def customers(keys: DataFrame, key: str, plan: Plan) -> DataFrame:
    """The customer master for a frame of distinct non-negative keys."""
    d = plan.draws("customer", F.col("k"))
    u = d.uniform("segment")
    segment = None
    for name, spec in rt.SEGMENTS.items():
        segment = F.when(u < spec[0], name) if segment is None else segment.when(u < spec[0], name)
    count = len(rt.MARKETS)
    # Two customers per market first, the rest at random.
    market = F.when(F.col("k") < 2 * count, F.col("k") % count).otherwise(d.whole("market", 0, count - 1))
    rows = keys.select(F.col(key).cast("bigint").alias("k")).withColumns({"segment": segment, "market": market})
    rows = rows.withColumn("target_arr", d.whole("arr", _by_segment(1, 0), _by_segment(1, 1)).cast("double"))
    cap = F.least(_by_segment(2, 1).cast("double"), F.col("target_arr") * rt.MAX_LIMIT_TO_ARR)
    rows = rows.withColumns({
        "target_limit": d.whole("limit", _by_segment(2, 0), F.floor(cap)).cast("double"),
        "arr_growth": cents(d.between("growth", _by_segment(4, 0), _by_segment(4, 1))),
        "drawdown_count": d.whole("drawdowns", _by_segment(3, 0), _by_segment(3, 1)),
        "facility_count": F.when(d.uniform("facilities") < 0.75, 1).when(d.uniform("facilities") < 0.95, 2).otherwise(3),
        "subscription_count": d.whole("subscriptions", 15, 44),
    })
    return rows.select(
        "k", d.identifier().alias("customer_id"), F.concat(F.lit("Company "), F.substring(d.digest("name"), 1, 16)).alias("company_name"),
        _market(F.col("market"), 0).alias("country_code"),
        _market(F.col("market"), 1).alias("home_currency"), "segment", "target_arr", "target_limit", "arr_growth",
        "drawdown_count", "facility_count", "subscription_count",
        d.whole("headcount", 5, 199).alias("headcount_at_application"),
        d.whole("valuation", 500000, 49999999).alias("valuation_at_application"),
        F.floor(F.col("target_arr") / (F.col("arr_growth") + 1)).alias("arr_at_application"),
    )


def _where_they_lie(rows: DataFrame, key: Column, ingested: Column, created: Column) -> DataFrame:
    return rows


def _days(rows: DataFrame) -> list[str]:
    return [name for name in DAY_COLUMNS if name in rows.columns]


def _each(df: DataFrame, count: Column) -> DataFrame:
    return df.withColumn("i", F.explode(F.sequence(F.lit(1), count.cast("int"))))


def _currency(d: Draws, clean: Column) -> Column:
    return F.when(d.chance("bad currency", rt.BAD_CURRENCY_RATE), d.pick("which currency", rt.BAD_CURRENCIES)).otherwise(clean)


def _blank(d: Draws, purpose: str, value: Column, p: float = 0.05) -> Column:
    return F.when(d.chance(purpose, p), "").otherwise(value)


def _negative(d: Draws, value: Column, p: float) -> Column:
    return F.when(d.chance("negative", p), -F.abs(value)).otherwise(value)


def _in_window(d: Draws, purpose: str, plan: Plan) -> Column:
    return after(plan.first_day, d.whole(purpose, 0, plan.days - 1))


def _before_start(d: Draws, purpose: str, plan: Plan, low: int, high: int) -> Column:
    return after(plan.first_day, -d.whole(purpose, low, high))


def _ingested(d: Draws, plan: Plan) -> Column:
    return _in_window(d, "ingested", plan).alias("_ingested_at")


def _doubled(rows: DataFrame, mark: str, condition: Column) -> DataFrame:
    """Every row once with ``mark`` false, and where ``condition`` holds once more with it true."""
    marks = F.when(condition, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    return rows.withColumn(mark, F.explode(marks))


def facility_id(plan: Plan, k: Column, i: Column) -> Column:
    return plan.draws("facility", k, i).identifier()


def subscriptions(master: DataFrame, plan: Plan, deal: Deal = _where_they_lie) -> DataFrame:
    d = plan.draws("subscription", F.col("k"), F.col("i"))
    created = _before_start(d, "created", plan, 1, 364)
    rows = deal(_each(master, F.col("subscription_count")), d.identifier(), _in_window(d, "ingested", plan), created)
    rows = rows.withColumn("start", _in_window(d, "start", plan))
    mrr = F.col("target_arr") / 12 / F.col("subscription_count")
    return rows.select(
        d.identifier().alias("subscription_id"), "customer_id",
        F.concat(F.lit("plan_"), d.whole("plan", 1, 20)).alias("plan_id"), d.pick("plan name", rt.PLANS).alias("plan_name"),
        cents(mrr * d.between("mrr", 0.5, 1.5)).alias("mrr_amount"),
        _currency(d, F.col("home_currency")).alias("currency"),
        F.when(d.chance("cancelled", 0.05), "cancelled").when(d.chance("paused", 0.03), "paused").otherwise("active").alias("status"),
        F.col("start").alias("billing_period_start"), after(F.col("start"), F.lit(30)).alias("billing_period_end"),
        d.whole("quantity", 1, 49).alias("quantity"), created.alias("created_at"),
        _ingested(d, plan), *_days(rows))


def invoices(master: DataFrame, plan: Plan, deal: Deal = _where_they_lie) -> DataFrame:
    c = plan.draws("customer", F.col("k"))
    d = plan.draws("invoice", F.col("k"), F.col("i"))
    rows = master.withColumn("invoice_count", c.whole("invoices", 30, 89))
    rows = deal(_each(rows, F.col("invoice_count")), d.identifier(), _in_window(d, "ingested", plan), _in_window(d, "issued", plan))
    rows = rows.withColumns({
        "issued": _in_window(d, "issued", plan), "is_paid": d.chance("paid", 0.85),
        "each": F.col("target_arr") / 12 / F.col("invoice_count")})
    linked = plan.draws("subscription", F.col("k"), d.whole("linked", 1, F.col("subscription_count"))).identifier()
    item = F.struct(F.concat(F.lit("service "), F.substring(d.digest("item"), 1, 6)).alias("description"),
                    cents(F.col("each") * d.between("item amount", 0.8, 1.2)).alias("amount"),
                    F.col("home_currency").alias("currency"))
    unpaid = F.when(d.chance("void", 0.05), "void").otherwise(d.pick("unpaid", ["open", "uncollectible"]))
    return rows.select(
        d.identifier().alias("invoice_id"), "customer_id",
        F.when(d.chance("has subscription", 0.80), linked).alias("subscription_id"),
        cents(F.col("each") * d.between("amount", 0.8, 1.2)).alias("amount"),
        _currency(d, F.col("home_currency")).alias("currency"), F.col("issued").alias("invoice_date"),
        after(F.col("issued"), F.lit(14)).alias("due_date"),
        F.when(F.col("is_paid"), after(F.col("issued"), d.whole("paid after", 1, 19))).alias("paid_at"),
        F.when(F.col("is_paid"), "paid").otherwise(unpaid).alias("status"),
        F.to_json(F.array(item)).alias("line_items_json"), F.col("issued").alias("created_at"), _ingested(d, plan),
        *_days(rows))


def loan_applications(master: DataFrame, plan: Plan, deal: Deal = _where_they_lie) -> DataFrame:
    """One approved application per customer, and a quarter as many that were
    not approved, from companies that never became customers."""
    d = plan.draws("application", F.col("k"))
    x = plan.draws("extra application", F.col("k"))

    def either(extra: Column, funded: Column) -> Column:
        return F.when(F.col("extra"), extra).otherwise(funded)

    application = either(x.identifier(), d.identifier())
    applied = either(_before_start(x, "applied", plan, 30, 179), _before_start(d, "applied", plan, 30, 364))
    ingested = either(_in_window(x, "ingested", plan), _in_window(d, "ingested", plan))
    rows = deal(_doubled(master, "extra", x.chance("extra", 0.25)), application, ingested, applied)
    registration = F.substring(F.conv(F.substring(d.digest("registration"), 1, 12), 16, 10), 1, 8)
    score = F.when(d.chance("good score", 0.98), d.whole("score", 300, 849)).otherwise(d.pick("bad score", rt.BAD_SCORES))
    return rows.select(
        application.alias("application_id"), either(x.identifier("customer"), F.col("customer_id")).alias("customer_id"),
        either(F.concat(F.lit("Company "), F.substring(x.digest("name"), 1, 16)), F.col("company_name")).alias("company_name"),
        _blank(d, "no registration", registration).alias("company_registration_number"),
        either(F.col("country_code"), _blank(d, "no country", F.col("country_code"))).alias("country_code"),
        F.lit("SaaS").alias("industry"),
        either(x.whole("amount", 50000, 1999999).cast("double"), F.col("target_limit")).alias("requested_amount"),
        either(F.col("home_currency"), _currency(d, F.col("home_currency"))).alias("currency"), applied.alias("application_date"),
        either(x.pick("status", ["rejected", "pending", "cancelled"]), F.lit("approved")).alias("status"),
        either(x.whole("score", 300, 849), score).alias("credit_score"),
        either(x.pick("risk", ["low", "medium", "high", "N/A"]), d.pick("risk", ["low", "medium", "high"])).alias("risk_rating"),
        either(x.whole("headcount", 5, 99), F.col("headcount_at_application")).alias("headcount_at_application"),
        either(x.whole("valuation", 500000, 9999999), F.col("valuation_at_application")).alias("valuation_at_application"),
        either(x.whole("arr", 200000, 4999999), F.col("arr_at_application")).alias("arr_at_application"),
        applied.alias("created_at"), ingested.alias("_ingested_at"), *_days(rows))


def credit_facilities(master: DataFrame, plan: Plan, deal: Deal = _where_they_lie) -> DataFrame:
    d = plan.draws("facility", F.col("k"), F.col("i"))
    approved_on = _before_start(d, "approved", plan, 30, 729)
    rows = deal(_each(master, F.col("facility_count")), d.identifier(), _in_window(d, "ingested", plan), approved_on).withColumns({
        "approved_on": approved_on,
        "full_limit": cents(F.col("target_limit") * F.when(F.col("i") > 1, 0.6).otherwise(1.0))})
    schedule = F.transform(F.sequence(F.lit(1), F.lit(12)), lambda n: F.struct(
        F.date_format(after(F.col("approved_on"), n * 30), "yyyy-MM-dd").alias("due_date"),
        cents(F.col("full_limit") * 0.05).alias("amount")))
    return rows.select(
        d.identifier().alias("facility_id"),
        F.when(d.chance("has application", 0.80), plan.draws("application", F.col("k")).identifier()).alias("application_id"),
        "customer_id", _negative(d, F.col("full_limit"), 0.01).alias("facility_limit"),
        _currency(d, F.col("home_currency")).alias("currency"), F.col("approved_on").alias("approval_date"),
        after(F.col("approved_on"), F.lit(730)).alias("maturity_date"),
        F.when(F.col("i") == F.col("facility_count"), "active").otherwise("closed").alias("status"),
        F.round(d.between("interest", 0.08, 0.18), 4).alias("interest_rate"),
        F.to_json(schedule).alias("repayment_schedule_json"), F.col("approved_on").alias("created_at"), _ingested(d, plan),
        *_days(rows))


def _drawdown_columns(plan: Plan) -> dict[str, Column]:
    """A drawdown's columns by customer ``k`` and number ``i``."""
    d = plan.draws("drawdown", F.col("k"), F.col("i"))
    own = facility_id(plan, F.col("k"), d.whole("facility", 1, F.col("facility_count")))
    return {
        "drawdown_id": F.when(~d.chance("null id", 0.02), d.identifier()),
        "facility_id": F.when(d.chance("orphan", 0.05), d.identifier("no facility")).otherwise(own),
        "positive": cents(F.col("target_limit") * d.between("amount", 0.1, 0.4)),
        "drawdown_date": after(plan.first_day, d.whole("drawn", 0, max(0, plan.days - 2))),
        "status": d.pick("status", ["completed", "completed", "completed", "pending", "failed"]),
    }


def drawdowns(master: DataFrame, plan: Plan, deal: Deal = _where_they_lie) -> DataFrame:
    d = plan.draws("drawdown", F.col("k"), F.col("i"))
    columns = _drawdown_columns(plan)
    # A duplicate arrives one second after the row it repeats.
    again = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("copy").cast("int").cast("decimal(18,6)"))
    ingested = _in_window(d, "ingested", plan) + again
    rows = _doubled(_each(master, F.col("drawdown_count")), "copy", d.chance("duplicate", rt.DUPLICATE_RATE))
    rows = deal(rows, columns["drawdown_id"], ingested, columns["drawdown_date"]).withColumns(columns)
    return rows.select(
        "drawdown_id", "facility_id", "customer_id", _negative(d, F.col("positive"), 0.03).alias("amount"),
        _currency(d, F.col("home_currency")).alias("currency"), "drawdown_date",
        d.pick("purpose", rt.PURPOSES).alias("purpose"), "status", F.col("drawdown_date").alias("created_at"),
        ingested.alias("_ingested_at"), *_days(rows))


def repayments(master: DataFrame, plan: Plan, deal: Deal = _where_they_lie) -> DataFrame:
    """Four to seven per completed drawdown, plus 2 % that belong to nothing."""
    dd = plan.draws("drawdown", F.col("k"), F.col("i"))
    d = plan.draws("repayment", F.col("k"), F.col("i"), F.col("n"))
    columns = _drawdown_columns(plan)

    def either(lost: Column, linked: Column) -> Column:
        return F.when(F.col("lost"), lost).otherwise(linked)

    completed = _each(master, F.col("drawdown_count")).filter(columns["status"] == "completed")
    rows = completed.withColumn("count", dd.whole("repayments", 4, 7)).withColumn(
        "n", F.explode(F.sequence(F.lit(1), F.col("count").cast("int"))))
    repayment = either(d.identifier("lost"), d.identifier())
    due = either(_in_window(d, "lost due", plan), after(columns["drawdown_date"], F.col("n") * 30))
    rows = deal(_doubled(rows, "lost", d.chance("orphan", rt.ORPHAN_RATE)), repayment, _in_window(d, "ingested", plan), due)
    rows = rows.withColumns(columns).withColumns({
        "due": due, "scheduled": cents(F.col("positive") / F.col("count") * d.between("share", 0.9, 1.1)),
        "is_paid": ~F.col("lost") & d.chance("paid", 0.85)})
    unpaid = either(F.lit("scheduled"), d.pick("unpaid", ["scheduled", "overdue"]))
    return rows.select(
        repayment.alias("repayment_id"), either(d.identifier("lost drawdown"), F.col("drawdown_id")).alias("drawdown_id"),
        either(d.identifier("lost facility"), F.col("facility_id")).alias("facility_id"),
        either(d.identifier("lost customer"), F.col("customer_id")).alias("customer_id"),
        either(d.whole("lost amount", 1000, 49999).cast("double"), F.col("scheduled")).alias("scheduled_amount"),
        F.when(F.col("is_paid"), F.col("scheduled")).alias("actual_amount"),
        _currency(d, F.col("home_currency")).alias("currency"), F.col("due").alias("due_date"),
        F.when(F.col("is_paid"), after(F.col("due"), d.whole("lag", -5, 9))).alias("actual_date"),
        F.when(F.col("is_paid"), "paid").otherwise(unpaid).alias("status"),
        F.col("due").alias("created_at"), _ingested(d, plan), *_days(rows))


def fx_transactions(master: DataFrame, plan: Plan, deal: Deal = _where_they_lie) -> DataFrame:
    c = plan.draws("customer", F.col("k"))
    d = plan.draws("fx", F.col("k"), F.col("i"))
    pairs = list(rt.FX_RATES)
    index = (d.whole("pair", 0, len(pairs) - 1) + 1).cast("int")

    def at(values: list[object]) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), F.col("pair"))

    rows = deal(_each(master, c.whole("fx", 8, 24)), d.identifier(), _in_window(d, "ingested", plan), _in_window(d, "booked", plan))
    rows = rows.withColumn("pair", index)
    direct = F.greatest(F.lit(rt.FX_FLOOR), F.round(at([rt.FX_RATES[p] for p in pairs]) + d.normal("noise", rt.FX_DEVIATION), 6))
    rows = rows.withColumn("direct", direct).withColumns({
        "rate": F.round(F.when(d.chance("inverse", 0.05), 1.0 / F.col("direct")).otherwise(F.col("direct")), 6),
        "base_amount": d.whole("amount", 1000, 499999), "booked": _in_window(d, "booked", plan)})
    return rows.select(
        d.identifier().alias("transaction_id"), "customer_id", at([p[0] for p in pairs]).alias("base_currency"),
        at([p[1] for p in pairs]).alias("quote_currency"), "base_amount",
        F.when(d.chance("has quote", 0.70), F.round(F.col("base_amount") * F.col("rate"), 2)).alias("quote_amount"), "rate",
        F.when(d.chance("has type", 0.90), d.pick("type", ["spot", "forward"])).alias("rate_type"),
        F.col("booked").alias("transaction_date"),
        F.when(d.chance("has bic", 0.80), F.concat(F.upper(F.substring(d.digest("bic"), 1, 4)), F.lit("GB2L"))).alias("counterparty_bank_bic"),
        F.col("booked").alias("created_at"), _ingested(d, plan), *_days(rows))


def account_balances(master: DataFrame, plan: Plan, deal: Deal = _where_they_lie) -> DataFrame:
    """One snapshot per customer and day, plus 2 % of unknown customers."""
    d = plan.draws("balance", F.col("k"), F.col("snapshot"))
    rows = master.withColumn("snapshot", F.explode(F.sequence(F.lit(0), F.lit(plan.days - 1))))
    snap = after(plan.first_day, F.col("snapshot"))

    def either(lost: Column, own: Column) -> Column:
        return F.when(F.col("lost"), lost).otherwise(own)

    identifier = either(d.identifier("lost"), d.identifier())
    rows = deal(_doubled(rows, "lost", d.chance("orphan", rt.ORPHAN_RATE)), identifier, _in_window(d, "ingested", plan), snap)
    account = either(F.concat(F.lit("acct_orphan_"), d.whole("lost account", 1, 999)),
                     F.concat(F.lit("acct_"), F.col("customer_id"), F.lit("_"), d.whole("account", 1, 3)))
    return rows.select(
        identifier.alias("snapshot_id"), either(d.identifier("lost customer"), F.col("customer_id")).alias("customer_id"),
        account.alias("account_id"), _currency(d, F.col("home_currency")).alias("currency"),
        d.whole("balance", 10000, 1999999).alias("balance"), snap.alias("snapshot_date"),
        d.pick("type", ["operating", "reserve", "fx"]).alias("account_type"), snap.alias("created_at"),
        _ingested(d, plan), *_days(rows))


def company_metrics(master: DataFrame, plan: Plan, deal: Deal = _where_they_lie) -> DataFrame:
    c = plan.draws("customer", F.col("k"))
    d = plan.draws("metric", F.col("k"), F.col("i"))
    measured = after(plan.first_day, d.whole("measured", 0, max(0, plan.days - 2)))
    rows = deal(_each(master, c.whole("metrics", 2, 4)), d.identifier(), _in_window(d, "ingested", plan), measured)
    rows = rows.withColumn("measured", measured)
    variance = F.when(d.chance("misreported", 0.30), d.between("variance", -0.15, 0.15)).otherwise(0.0)
    return rows.select(
        d.identifier().alias("metric_id"), "customer_id", F.col("measured").alias("metric_date"),
        F.floor(F.col("headcount_at_application") * (d.uniform("team") * F.col("arr_growth") + 1)).alias("headcount"),
        F.floor(F.col("valuation_at_application") * (d.uniform("worth") * F.col("arr_growth") + 1)).alias("valuation"),
        F.floor(F.col("target_arr") * (variance + 1)).alias("arr_reported"),
        F.col("measured").alias("created_at"), _ingested(d, plan), *_days(rows))


GENERATORS: dict[str, Callable[..., DataFrame]] = {
    "subscriptions": subscriptions,
    "invoices": invoices,
    "loan_applications": loan_applications,
    "credit_facilities": credit_facilities,
    "drawdowns": drawdowns,
    "repayments": repayments,
    "fx_transactions": fx_transactions,
    "account_balances": account_balances,
    "company_metrics": company_metrics,
}
