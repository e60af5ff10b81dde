"""The star schema: two dimensions and three facts."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomledger.functions import columns as c
from loomledger.operators.keys import distinct_keys, missing_any, with_parent
from loomledger.operators.latest import first_by, latest_and_prior
from loomledger.plans.intermediate import completed_draws

MART_NAMES = [
    "dim_customers", "dim_credit_facilities", "fct_drawdowns", "fct_repayments", "fct_fx_transactions",
]

# Staged columns that a mart's column is computed from, where they bear other names.
_COMPUTED_FROM = {
    "facility_status": ("status",),
    "days_since_facility_approval": ("drawdown_date",),
    "scheduled_vs_actual_lag_days": ("due_date", "actual_date"),
    "currency_pair": ("base_currency", "quote_currency"),
    "notional_base": ("base_amount",),
    "notional_quote": ("quote_amount",),
    "effective_rate": ("rate",),
}


def staged_for(columns: Collection[str]) -> list[str]:
    """The staged columns that these columns of a fact, or of the facilities, are computed from."""
    return [name for column in columns for name in _COMPUTED_FROM.get(column, (column,))]


def _chosen(rows: DataFrame, every: dict[str, Column], columns: Collection[str]) -> DataFrame:
    """All columns of ``every``, or those named in ``columns``; the others need not be computable."""
    return rows.select(*[column.alias(name) for name, column in every.items() if not columns or name in columns])


# --- parts of the customer dimension --------------------------------------

def approved(applications: DataFrame) -> DataFrame:
    return applications.filter(F.col("status") == "approved")


def latest_application(applications: DataFrame) -> DataFrame:
    """The application that a customer's company columns come from."""
    return first_by(
        approved(applications).select(
            "customer_id", "company_name", "country_code", "industry", "headcount_at_application",
            "valuation_at_application", "arr_at_application", "application_date", "application_id",
        ),
        ["customer_id"],
        [F.desc_nulls_last("application_date"), F.desc_nulls_last("application_id")],
    ).drop("application_date", "application_id")


def customer_keys(applications: DataFrame) -> DataFrame:
    """Exactly the keys of ``dim_customers``, without building it."""
    return distinct_keys(approved(applications), "customer_id")


def active_limits(facilities: DataFrame) -> DataFrame:
    return (
        facilities.filter(F.col("status") == "active")
        .groupBy("customer_id")
        .agg(c.money_sum(F.col("facility_limit")).alias("total_facility_limit"))
    )


def balance_per_currency(balances: DataFrame) -> DataFrame:
    return balances.groupBy("customer_id", "currency").agg(
        F.avg(F.col("balance").cast("double")).alias("avg_balance")
    )


def primary_currency(balances: DataFrame) -> DataFrame:
    """Currency with the highest average balance; ties go to the first code."""
    return first_by(
        balance_per_currency(balances), ["customer_id"],
        [F.desc_nulls_last("avg_balance"), F.asc_nulls_last("currency")],
    ).select("customer_id", F.col("currency").alias("primary_account_currency"))


def metric_snapshots(metrics: DataFrame) -> DataFrame:
    return latest_and_prior(
        metrics.select("customer_id", "headcount", "valuation", "arr_reported", "metric_date", "metric_id"),
        "customer_id",
        [F.desc_nulls_last("metric_date"), F.desc_nulls_last("metric_id")],
        latest={"headcount": "current_headcount", "valuation": "current_valuation", "arr_reported": "arr_reported"},
        prior={"headcount": "prior_headcount", "valuation": "prior_valuation"},
    )


# Columns of ``dim_customers`` by the side that they come from.
COMPANY = ("company_name", "country_code", "industry", "headcount_at_application", "valuation_at_application", "arr_at_application")
OF_ARR = ("lifetime_arr", "arr_growth_pct", "arr_variance_pct")
OF_METRICS = ("current_headcount", "current_valuation", "team_growth_pct", "valuation_increase_multiple", "arr_variance_pct")


def dim_customers(
    applications: DataFrame, facilities: DataFrame, drawdowns: DataFrame,
    balances: DataFrame, metrics: DataFrame, arr: DataFrame, columns: Collection[str] = (),
) -> DataFrame:
    """One row per customer with an approved application.

    Each side is grouped by customer before it is joined, so the left joins
    reuse that partitioning: the inputs are shuffled once, after map-side
    aggregation, and the joins add no exchange of their own. With ``columns``
    only those, and the sides that none of them needs are not joined.
    """
    zero = F.lit(0).cast(c.MONEY_SUM)
    current_arr = F.col("current_arr")
    headcount, prior_headcount = F.col("current_headcount"), F.col("prior_headcount")
    asked = lambda *names: not columns or not set(names).isdisjoint(columns)
    rows = latest_application(applications) if asked(*COMPANY) else customer_keys(applications)
    if asked(*OF_ARR):
        rows = rows.join(arr, "customer_id", "left")
    if asked("total_facility_limit"):
        rows = rows.join(active_limits(facilities), "customer_id", "left")
    if asked("total_drawn_amount"):
        rows = rows.join(completed_draws(drawdowns, "customer_id"), "customer_id", "left")
    if asked("primary_account_currency"):
        rows = rows.join(primary_currency(balances), "customer_id", "left")
    if asked(*OF_METRICS):
        rows = rows.join(metric_snapshots(metrics), "customer_id", "left")
    return _chosen(rows, {
        "customer_id": F.col("customer_id"), **{name: F.col(name) for name in COMPANY},
        "lifetime_arr": F.coalesce(current_arr, F.lit(0.0)),
        "arr_growth_pct": F.col("arr_growth_pct"),
        "total_facility_limit": F.coalesce("total_facility_limit", zero),
        "total_drawn_amount": F.coalesce("total_drawn_amount", zero),
        "primary_account_currency": F.col("primary_account_currency"),
        "current_headcount": headcount, "current_valuation": F.col("current_valuation"),
        "team_growth_pct": c.ratio(headcount - prior_headcount, prior_headcount, 100),
        "valuation_increase_multiple": c.ratio(F.col("current_valuation"), F.col("prior_valuation")),
        "arr_variance_pct": c.ratio(F.col("arr_reported").cast("double") - current_arr, current_arr, 100),
        "is_orphaned": F.lit(False),
    }, columns)


def dim_credit_facilities(positions: DataFrame, customers: DataFrame, columns: Collection[str] = ()) -> DataFrame:
    """One row per staged facility.

    ``positions`` are the facility positions: staged facilities are the ones
    that are not orphaned there, so they are not read a second time.
    """
    staged = positions.filter(~F.col("is_orphaned")).drop("is_orphaned")
    return _chosen(with_parent(staged, customers, "customer_id", "has_customer"), {
        **{name: F.col(name) for name in ("facility_id", "application_id", "customer_id", "facility_limit", "currency",
                                          "approval_date", "maturity_date")},
        "facility_status": F.col("status"),
        "interest_rate": F.col("interest_rate"), "current_utilization_pct": F.col("current_utilization_pct"),
        "is_orphaned": missing_any("has_customer"),
    }, columns)


def lending_parents(fact: DataFrame, facilities: DataFrame, customers: DataFrame,
                    carry: tuple[str, ...] = ()) -> DataFrame:
    """A fact with ``has_facility`` and ``has_customer``, and ``carry`` from the facility."""
    linked = with_parent(fact, facilities, "facility_id", "has_facility", carry)
    return with_parent(linked, customers, "customer_id", "has_customer")


def orphan_flags(fact: DataFrame, customers: DataFrame, facilities: DataFrame | None = None) -> DataFrame:
    """Only whether each row of a fact lacks a parent; the fact needs no more than its parents' keys."""
    if facilities is not None:
        return lending_parents(fact, facilities, customers).select(
            missing_any("has_facility", "has_customer").alias("is_orphaned"))
    return with_parent(fact, customers, "customer_id", "has_customer").select(missing_any("has_customer").alias("is_orphaned"))


def fct_drawdowns(drawdowns: DataFrame, facilities: DataFrame, customers: DataFrame, columns: Collection[str] = ()) -> DataFrame:
    """``facilities`` and ``customers`` need only their keys (and approval date, where the fact's age is asked for)."""
    dated = not columns or "days_since_facility_approval" in columns
    return drawdown_columns(lending_parents(drawdowns, facilities, customers, ("approval_date",) if dated else ()), columns)


def drawdown_columns(linked: DataFrame, columns: Collection[str] = ()) -> DataFrame:
    return _chosen(linked, {
        **{name: F.col(name) for name in ("drawdown_id", "facility_id", "customer_id", "amount", "currency", "drawdown_date",
                                          "purpose", "status")},
        "days_since_facility_approval": c.days_between(F.col("approval_date"), F.col("drawdown_date")),
        "is_orphaned": missing_any("has_facility", "has_customer"),
    }, columns)


def fct_repayments(repayments: DataFrame, facilities: DataFrame, customers: DataFrame, columns: Collection[str] = ()) -> DataFrame:
    return repayment_columns(lending_parents(repayments, facilities, customers), columns)


def repayment_columns(linked: DataFrame, columns: Collection[str] = ()) -> DataFrame:
    return _chosen(linked, {
        **{name: F.col(name) for name in ("repayment_id", "drawdown_id", "facility_id", "customer_id", "scheduled_amount",
                                          "actual_amount", "currency", "due_date", "actual_date")},
        "scheduled_vs_actual_lag_days": c.days_between(F.col("due_date"), F.col("actual_date")),
        "status": F.col("status"),
        "is_orphaned": missing_any("has_facility", "has_customer"),
    }, columns)


def fct_fx_transactions(fx_transactions: DataFrame, customers: DataFrame, columns: Collection[str] = ()) -> DataFrame:
    return _chosen(with_parent(fx_transactions, customers, "customer_id", "has_customer"), {
        **{name: F.col(name) for name in ("transaction_id", "customer_id", "base_currency", "quote_currency")},
        "currency_pair": c.currency_pair(F.col("base_currency"), F.col("quote_currency"), "/"),
        "notional_base": F.col("base_amount"), "notional_quote": F.col("quote_amount"),
        "effective_rate": F.col("rate"), "rate_type": F.col("rate_type"), "transaction_date": F.col("transaction_date"),
        "is_orphaned": missing_any("has_customer"),
    }, columns)
