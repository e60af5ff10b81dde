"""The report pack over the marts.

Fact reports leave orphaned rows out unless the report is about them. Every
ordered limit ends in a unique column, so the rows kept are the same on
every run, and is planned as a per-task top-k.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomledger.functions import columns as c
from loomledger.functions import fixed
from loomledger.operators.shares import with_share
from loomledger.plans.intermediate import eur_rates, with_eur_rate


def linked(fact: DataFrame) -> DataFrame:
    return fact.filter(~F.col("is_orphaned"))


def top(df: DataFrame, by: str, tie_break: str, k: int) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(by), F.asc_nulls_last(tie_break)).limit(k)


def totals_of_linked(fact: DataFrame, facilities: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """Sums per customer of fact rows whose facility is known, from staged facts.

    Rows are added up per (facility, customer) below the lookup of the facility, so
    no join sees more than one row of a pair, however many a customer has; the
    joins need no skew handling and no session setting. ``facilities`` is unique on
    its key. Whether the customer is known is left to the join that follows.
    """
    pairs = fact.filter(F.col("facility_id").isNotNull() & F.col("customer_id").isNotNull()).groupBy(
        "facility_id", "customer_id").agg(*[value.alias(name) for name, value in measures.items()])
    known = pairs.join(facilities.select("facility_id"), "facility_id", "left_semi")
    return known.groupBy("customer_id").agg(*[F.sum(name).alias(name) for name in measures])


# --- customers --------------------------------------------------------------

def top_customers(customers: DataFrame, by: str, k: int) -> DataFrame:
    ranked = top(customers, by, "customer_id", k)
    return ranked.select("company_name", "lifetime_arr", "total_facility_limit", "total_drawn_amount")


def concentration(customers: DataFrame, k: int = 5) -> DataFrame:
    """Share of the whole facility book held by the k largest customers."""
    funded = customers.filter(F.col("total_facility_limit") > 0).select("customer_id", "total_facility_limit")
    shares = with_share(funded, "total_facility_limit", "share")
    return top(shares, "total_facility_limit", "customer_id", k).select(
        "customer_id", "total_facility_limit", F.round(F.col("share") * 100, 2).alias("pct_of_total"))


def customer_profile(customers: DataFrame, customer_id: str) -> DataFrame:
    return customers.filter(F.col("customer_id") == customer_id)


def overdrawn_customers(customers: DataFrame) -> DataFrame:
    return customers.filter(F.col("total_drawn_amount") > F.col("total_facility_limit")).select(
        "customer_id", "company_name", "total_facility_limit", "total_drawn_amount")


def arr_to_limit(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id", "lifetime_arr", "total_facility_limit",
        c.ratio(F.col("lifetime_arr"), F.col("total_facility_limit")).alias("arr_to_limit"))


# --- facilities -------------------------------------------------------------

def portfolio_by_status(facilities: DataFrame) -> DataFrame:
    return (
        facilities.groupBy("facility_status")
        .agg(F.count("*").alias("facilities"),
             c.money_sum(F.col("facility_limit")).alias("total_limit"),
             F.avg("current_utilization_pct").alias("avg_util_pct"))
        .orderBy(F.desc("facilities"), F.asc_nulls_last("facility_status"))
    )


def currency_mix(facilities: DataFrame) -> DataFrame:
    return (
        facilities.groupBy(c.null_label(F.col("currency")).alias("currency"))
        .agg(F.count("*").alias("facilities"), c.money_sum(F.col("facility_limit")).alias("total_limit"))
        .orderBy(F.desc("facilities"), "currency")
    )


def active_facilities(facilities: DataFrame) -> DataFrame:
    return facilities.filter(F.col("facility_status") == "active").agg(
        F.count("*").alias("facilities"), c.money_sum(F.col("facility_limit")).alias("total_limit"))


def over_utilised(facilities: DataFrame, above_pct: float = 100.0) -> DataFrame:
    return facilities.filter(
        (F.col("facility_status") == "active") & (F.col("current_utilization_pct") > above_pct)
    ).select("facility_id", "customer_id", "facility_limit", "current_utilization_pct")


# --- drawdowns --------------------------------------------------------------

def drawdowns_per_month(drawdowns: DataFrame, as_of: Column | None = None, months: int | None = None) -> DataFrame:
    """Count and amount per month; a missing date is a month of its own.

    With ``as_of`` and ``months`` only the last months before it are counted.
    """
    rows = linked(drawdowns)
    if as_of is not None and months is not None:
        rows = rows.filter(F.col("drawdown_date") >= c.months_before(as_of, months))
    return (
        rows.groupBy(c.month_of(F.col("drawdown_date")).alias("month"))
        .agg(F.count("*").alias("drawdowns"), c.money_sum(F.col("amount")).alias("total_amount"))
        .orderBy(F.asc_nulls_last("month"))
    )


def drawdown_history(drawdowns: DataFrame, customer_id: str) -> DataFrame:
    return (
        linked(drawdowns).filter(F.col("customer_id") == customer_id)
        .select("drawdown_date", "amount", "currency", "status")
        .orderBy(*[F.asc_nulls_last(name) for name in ("drawdown_date", "amount", "currency", "status")])
    )


def days_to_drawdown(drawdowns: DataFrame) -> DataFrame:
    days = "days_since_facility_approval"
    return linked(drawdowns).agg(
        F.min(days).alias("min_days"), F.avg(days).alias("avg_days"), F.max(days).alias("max_days"))


def drawn_per_company(drawdowns: DataFrame, customers: DataFrame) -> DataFrame:
    """Drawn total per company name.

    Amounts are summed per customer before the join, so the join moves one
    row per customer and no hot customer reaches a single task.
    """
    per_customer = linked(drawdowns).groupBy("customer_id").agg(c.money_sum(F.col("amount")).alias("drawn"))
    return _per_company(per_customer, customers)


def drawn_per_company_staged(drawdowns: DataFrame, facilities: DataFrame, customers: DataFrame) -> DataFrame:
    """``drawn_per_company`` from staged drawdowns: added up before the parents are looked up."""
    return _per_company(totals_of_linked(drawdowns, facilities, {"drawn": c.money_sum(F.col("amount"))}), customers)


def _per_company(per_customer: DataFrame, customers: DataFrame) -> DataFrame:
    return (
        per_customer.join(customers.select("customer_id", "company_name"), "customer_id")
        .groupBy("company_name").agg(c.money_sum(F.col("drawn")).alias("total_drawn"))
    )


def drawdown_status_counts(drawdowns: DataFrame) -> DataFrame:
    return drawdowns.agg(
        F.count_if(F.col("status") == "completed").alias("completed"),
        F.count_if(F.col("status") == "pending").alias("pending"))


# --- repayments -------------------------------------------------------------

def repayment_lateness(repayments: DataFrame) -> DataFrame:
    lag = F.col("scheduled_vs_actual_lag_days")
    return (
        linked(repayments).filter(F.col("actual_date").isNotNull())
        .groupBy(c.lateness_bucket(lag).alias("bucket"))
        .agg(F.count("*").alias("repayments"),
             c.money_sum(F.col("actual_amount")).alias("total_amount"),
             F.min(lag).alias("least_lag"))
        .orderBy(F.asc_nulls_last("least_lag"))
        .drop("least_lag")
    )


def repayment_health(repayments: DataFrame, customer_id: str) -> DataFrame:
    return linked(repayments).filter(F.col("customer_id") == customer_id).agg(
        F.count("*").alias("scheduled_repayments"),
        F.count_if(F.col("actual_date").isNotNull()).alias("paid_repayments"),
        F.avg("scheduled_vs_actual_lag_days").alias("avg_lag_days"))


def repayment_watchlist(repayments: DataFrame, customers: DataFrame, more_than: int = 5, k: int = 10) -> DataFrame:
    """Companies with the highest average lag among those with enough repayments.

    Counts and sums are taken per customer before the join and then added up
    per company name.
    """
    measures = _watched(F.col("scheduled_vs_actual_lag_days"))
    per_customer = linked(repayments).groupBy("customer_id").agg(*[value.alias(name) for name, value in measures.items()])
    return _watchlist(per_customer, customers, more_than, k)


def repayment_watchlist_staged(repayments: DataFrame, facilities: DataFrame, customers: DataFrame,
                               more_than: int = 5, k: int = 10) -> DataFrame:
    """``repayment_watchlist`` from staged repayments: added up before the parents are looked up."""
    lag = c.days_between(F.col("due_date"), F.col("actual_date"))
    return _watchlist(totals_of_linked(repayments, facilities, _watched(lag)), customers, more_than, k)


def _watched(lag: Column) -> dict[str, Column]:
    return {"scheduled": F.count("repayment_id"), "paid": F.count("actual_date"), "lag_sum": F.sum(lag), "lag_count": F.count(lag)}


def _watchlist(per_customer: DataFrame, customers: DataFrame, more_than: int, k: int) -> DataFrame:
    companies = (
        per_customer.join(customers.select("customer_id", "company_name"), "customer_id")
        .groupBy("company_name")
        .agg(F.sum("scheduled").alias("scheduled"), F.sum("paid").alias("paid"),
             F.sum("lag_sum").alias("lag_sum"), F.sum("lag_count").alias("lag_count"))
        .filter(F.col("scheduled") > more_than)
        .select("company_name", "scheduled", "paid",
                F.round(c.ratio(F.col("lag_sum"), F.col("lag_count")), 1).alias("avg_lag_days"))
    )
    return top(companies, "avg_lag_days", "company_name", k)


# --- exchange ---------------------------------------------------------------

def fx_by_pair(fx: DataFrame, k: int = 6) -> DataFrame:
    pairs = linked(fx).groupBy("currency_pair").agg(
        F.count("*").alias("transactions"), c.money_sum(F.col("notional_base")).alias("total_notional_base"))
    return top(pairs, "transactions", "currency_pair", k)


def busiest_pair(fx: DataFrame, as_of: Column, months: int = 3) -> DataFrame:
    """The pair with the largest volume in the last quarter."""
    recent = linked(fx).filter(F.col("transaction_date") >= c.months_before(as_of, months))
    pairs = recent.groupBy("currency_pair").agg(
        F.count("*").alias("transactions"), c.money_sum(F.col("notional_base")).alias("total_notional_base"))
    return top(pairs, "total_notional_base", "currency_pair", 1)


# --- data quality and cross-checks ------------------------------------------

def orphan_census(drawdowns: DataFrame, repayments: DataFrame, fx: DataFrame) -> DataFrame:
    def census(entity: str, fact: DataFrame) -> DataFrame:
        counts = fact.agg(F.count_if(F.col("is_orphaned")).alias("orphans"), F.count("*").alias("total"))
        pct = F.round(c.ratio(F.col("orphans"), F.col("total"), 100), 1)
        return counts.select(F.lit(entity).alias("entity"), "orphans", "total", pct.alias("orphan_pct"))

    parts = census("drawdowns", drawdowns), census("repayments", repayments), census("fx_transactions", fx)
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def invoiced_revenue(invoices: DataFrame, fx_transactions: DataFrame, arr: DataFrame, as_of: Column) -> DataFrame:
    """Paid, subscription-linked invoices of the trailing year per customer,
    in EUR, next to the ARR computed from subscriptions."""
    paid = invoices.filter(
        (F.col("status") == "paid") & F.col("subscription_id").isNotNull() & F.col("customer_id").isNotNull()
        & (F.col("invoice_date") > c.months_before(as_of, 12)) & (F.col("invoice_date") <= as_of))
    rated = with_eur_rate(paid.select("customer_id", "amount", "currency"), eur_rates(fx_transactions))
    eur = c.to_eur(F.col("amount"), F.col("currency"), F.col("rate_to_eur"))
    per_customer = rated.groupBy("customer_id").agg(
        F.count("*").alias("invoices"), F.sum(eur).alias("invoiced_eur"))
    return per_customer.join(arr.select("customer_id", "current_arr"), "customer_id", "left")


def arr_by_month(subscriptions: DataFrame, fx_transactions: DataFrame) -> DataFrame:
    """ARR billed per customer and month, with growth over the month before."""
    active = subscriptions.filter(
        (F.col("status") == "active") & F.col("customer_id").isNotNull() & F.col("billing_period_start").isNotNull())
    rated = with_eur_rate(
        active.select("customer_id", "mrr_amount", "currency", "billing_period_start"), eur_rates(fx_transactions))
    eur = c.to_eur(F.col("mrr_amount"), F.col("currency"), F.col("rate_to_eur"))
    monthly = rated.groupBy("customer_id", c.month_of(F.col("billing_period_start")).alias("month")).agg(
        (F.coalesce(F.sum(eur), F.lit(0.0)) * fixed.MONTHS_PER_YEAR).alias("arr"))
    order = Window.partitionBy("customer_id").orderBy("month")
    follows = F.lag("month").over(order) == c.months_before(F.col("month"), 1)
    before = F.when(follows, F.lag("arr").over(order))
    return monthly.withColumn("previous_arr", before).withColumn(
        "growth_pct", c.ratio(F.col("arr") - F.col("previous_arr"), F.col("previous_arr"), 100))
