"""Business rules between staging and the star schema."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomledger.functions import columns as c
from loomledger.functions import fixed
from loomledger.operators.keys import merge_by_key
from loomledger.operators.latest import earliest_value, first_by

SCHEDULE = "array<struct<due_date string, amount string>>"


# --- recurring revenue ----------------------------------------------------

def as_of_instant(newest: DataFrame, now: Column | None = None) -> Column:
    """The smaller of now and the newest ingestion; now when there is no data.

    ``newest`` is a one-row frame. The result is a scalar subquery, so it is
    evaluated once and used as a literal by every filter.
    """
    now = F.localtimestamp() if now is None else now
    return newest.agg(F.least(now, F.coalesce(F.max("newest"), now)).alias("as_of")).scalar()


def eur_rates(fx_transactions: DataFrame) -> DataFrame:
    """The newest usable rate to EUR per base currency.

    Base currencies come out of the allow-list, so there is at most one row
    per listed code, plus one for NULL that can match nothing and is dropped.
    """
    usable = fx_transactions.filter(
        (F.col("quote_currency") == "EUR") & (F.col("rate") > 0) & F.col("base_currency").isNotNull()
    ).select("base_currency", "rate", "transaction_date", "transaction_id")
    newest = first_by(
        usable, ["base_currency"],
        [F.desc_nulls_last("transaction_date"), F.desc_nulls_last("transaction_id")],
    )
    return newest.select(F.col("base_currency").alias("currency"), F.col("rate").alias("rate_to_eur"))


def with_eur_rate(rows: DataFrame, rates: DataFrame) -> DataFrame:
    """Attach the rate by currency. ``rates`` has one row per listed code at
    most, a bound set by the code list and not by the data, hence the hint."""
    return rows.join(F.broadcast(rates), "currency", "left")


def arr_per_customer(subscriptions: DataFrame, fx_transactions: DataFrame, as_of: Column) -> DataFrame:
    """Current ARR, subscription count and growth per subscription customer.

    One pass: each subscription is flagged as current, past or neither, and a
    single aggregation by customer computes the current sum, the past sum and
    the earliest subscription together. Customers with no active subscription
    fall out of the same groups.
    """
    past_instant = c.days_before(as_of, fixed.ARR_LOOKBACK_DAYS)
    active = F.col("status") == "active"
    is_current = active & (F.col("billing_period_end") > as_of)
    is_past = (
        active
        & (F.col("billing_period_start") <= past_instant)
        & (F.col("billing_period_end") > past_instant)
    )
    mrr_eur = F.col("mrr_eur")

    rows = (
        with_eur_rate(
            subscriptions.select(
                "customer_id", "subscription_id", "mrr_amount", "currency", "created_at", "billing_period_start",
                F.coalesce(active, F.lit(False)).alias("is_active"),
                F.coalesce(is_current, F.lit(False)).alias("is_current"),
                F.coalesce(is_past, F.lit(False)).alias("is_past"),
            ),
            eur_rates(fx_transactions),
        )
        .withColumn("mrr_eur", c.to_eur(F.col("mrr_amount"), F.col("currency"), F.col("rate_to_eur")))
    )

    per_customer = rows.groupBy("customer_id").agg(
        F.sum(F.when(F.col("is_current"), mrr_eur)).alias("current_mrr"),
        F.count_if(F.col("is_current")).alias("current_count"),
        F.sum(F.when(F.col("is_past"), mrr_eur)).alias("past_mrr"),
        F.count_if(F.col("is_past")).alias("past_count"),
        earliest_value(
            mrr_eur,
            [
                # inactive subscriptions sort behind every active one
                F.when(F.col("is_active"), F.lit(0)),
                F.col("billing_period_start"), F.col("created_at"), F.col("subscription_id"),
            ],
        ).alias("first_mrr"),
        F.max("is_active").alias("any_active"),
    )

    months = F.lit(float(fixed.MONTHS_PER_YEAR))
    known = F.col("customer_id").isNotNull()
    # A NULL customer is listed but never matches its own sums.
    current = F.when(known & (F.col("current_count") > 0), F.coalesce("current_mrr", F.lit(0.0)) * months)
    past = F.when(F.col("past_count") > 0, F.coalesce("past_mrr", F.lit(0.0)) * months)
    first = F.when(F.col("any_active"), F.col("first_mrr") * months)
    baseline = F.when(known, F.coalesce(past, first))
    current_arr = F.coalesce(current, F.lit(0.0))
    return per_customer.select(
        "customer_id",
        current_arr.alias("current_arr"),
        F.when(known, F.col("current_count")).otherwise(F.lit(0)).cast("bigint").alias("subscription_count"),
        F.when(baseline != 0, (current_arr - baseline) / baseline * F.lit(100.0)).alias("arr_growth_pct"),
    )


# --- facilities -----------------------------------------------------------

def completed_draws(drawdowns: DataFrame, key: str) -> DataFrame:
    """Completed drawdown total per facility or customer."""
    return (
        drawdowns.filter(F.col("status") == "completed")
        .groupBy(key)
        .agg(c.money_sum(F.col("amount")).alias("total_drawn_amount"))
    )


def facility_positions(facilities: DataFrame, drawdowns: DataFrame) -> DataFrame:
    """Every facility id seen in facilities or completed drawdowns, with all
    facility columns, its drawn total, utilisation and orphan flag."""
    merged = merge_by_key(
        facilities.withColumn("__staged", F.lit(True)), completed_draws(drawdowns, "facility_id"), "facility_id"
    )
    # Draws without a facility id form one row that matches nothing: drawn is 0.
    drawn = F.when(F.col("facility_id").isNotNull(), F.col("total_drawn_amount"))
    drawn = F.coalesce(drawn, F.lit(0).cast(c.MONEY_SUM))
    return (
        merged.withColumn("total_drawn_amount", drawn)
        .withColumn(
            "current_utilization_pct",
            c.ratio(F.col("total_drawn_amount"), F.col("facility_limit")) * F.lit(100.0),
        )
        .withColumn("is_orphaned", F.col("__staged").isNull())
        .drop("__staged")
    )


def facility_utilization(facilities: DataFrame, drawdowns: DataFrame) -> DataFrame:
    return facility_positions(facilities, drawdowns).select(
        "facility_id", "customer_id", "facility_limit", "currency",
        F.col("status").alias("facility_status"),
        "total_drawn_amount", "current_utilization_pct", "is_orphaned",
    )


def repayment_schedule(facilities: DataFrame, strict: bool = True) -> DataFrame:
    """One row per instalment of every facility that has a schedule.

    Objects are exploded whole, so an instalment without an amount keeps its
    own due date. ``strict`` fails the job on a value that is not a date or a
    number; otherwise such values become NULL.
    """
    schedule = F.col("repayment_schedule_json")
    due, amount = F.col("due_date"), F.col("amount")
    instalments = facilities.filter(schedule.isNotNull() & (schedule != "")).select(
        "facility_id", "customer_id", "currency", F.inline(F.from_json(schedule, SCHEDULE))
    )
    cast = (lambda col, kind: col.cast(kind)) if strict else (lambda col, kind: col.try_cast(kind))
    return instalments.select(
        "facility_id", "customer_id", "currency",
        cast(due, "date").alias("installment_due_date"),
        cast(amount, c.PLAIN_DECIMAL).alias("installment_amount"),
    )


# --- exchange rates -------------------------------------------------------

def fx_rates_normalized(fx_transactions: DataFrame, columns: Collection[str] = ()) -> DataFrame:
    """One row per transaction; with ``columns`` only those."""
    rate = c.harmonised_rate(F.col("rate"))
    every = {
        **{name: F.col(name) for name in ("transaction_id", "customer_id", "base_currency", "quote_currency")},
        "currency_pair": c.currency_pair(F.col("base_currency"), F.col("quote_currency")),
        "base_amount": F.col("base_amount"),
        "quote_amount": c.quote_or_estimate(F.col("quote_amount"), F.col("base_amount"), rate),
        "effective_rate": rate,
        "rate_type": F.col("rate_type"), "transaction_date": F.col("transaction_date"),
        "is_orphaned": F.lit(False),
    }
    return fx_transactions.select(*[column.alias(name) for name, column in every.items() if not columns or name in columns])
