"""Data-quality checks: declared next to the models, run as aggregates.

A result is one row per check: model, column, test, severity, failures and
status. Column checks of a model share a single pass over it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from loomledger.functions import fixed
from loomledger.operators.keys import broken_links
from loomledger.plans.entities import ENTITIES
from loomledger.plans.warehouse import Warehouse
from loomledger.sources.envelope import ENVELOPE, RAW_ROOT

ERROR, WARN = "error", "warn"
# Tests that look at one row at a time.
BY_ROW = ("not_null", "accepted_values", "expression_is_true")
RESULT_COLUMNS = ["model", "column", "test", "severity", "failures", "status"]


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    test: str
    severity: str = ERROR
    values: tuple[object, ...] = ()
    parent: tuple[str, str] | None = None
    expression: str | None = None


def unique(model: str, column: str) -> Check:
    return Check(model, column, "unique")


def not_null(model: str, column: str, severity: str = ERROR) -> Check:
    return Check(model, column, "not_null", severity)


def accepted(model: str, column: str, values: Iterable[object], severity: str = ERROR) -> Check:
    return Check(model, column, "accepted_values", severity, values=tuple(values))


def relationship(model: str, column: str, parent: str, parent_column: str | None = None) -> Check:
    return Check(model, column, "relationships", WARN, parent=(parent, parent_column or column))


def holds(model: str, column: str, expression: str, severity: str = WARN) -> Check:
    return Check(model, column, "expression_is_true", severity, expression=expression)


# --- the declared suite -------------------------------------------------------

# Per staging entity the references that must be present, the
# amounts that should be present, and the code columns with their lists.
_STAGING_RULES: dict[str, tuple[list[str], list[str], dict[str, list[str]]]] = {
    "subscriptions": (["customer_id"], ["mrr_amount"],
                      {"currency": fixed.CURRENCIES, "status": fixed.SUBSCRIPTION_STATUSES}),
    "invoices": (["customer_id"], ["amount"],
                 {"currency": fixed.CURRENCIES, "status": fixed.INVOICE_STATUSES}),
    "loan_applications": (["customer_id"], ["requested_amount"],
                          {"country_code": fixed.COUNTRIES, "currency": fixed.CURRENCIES,
                           "status": fixed.APPLICATION_STATUSES}),
    "credit_facilities": (["customer_id"], ["facility_limit"],
                          {"currency": fixed.CURRENCIES, "status": fixed.FACILITY_STATUSES}),
    "drawdowns": (["facility_id", "customer_id"], ["amount"],
                  {"currency": fixed.CURRENCIES, "status": fixed.DRAWDOWN_STATUSES}),
    "repayments": (["drawdown_id", "facility_id", "customer_id"], ["scheduled_amount"],
                   {"currency": fixed.CURRENCIES, "status": fixed.REPAYMENT_STATUSES}),
    "fx_transactions": (["customer_id"], ["base_amount"],
                        {"base_currency": fixed.CURRENCIES, "quote_currency": fixed.CURRENCIES}),
    "account_balances": (["customer_id"], ["balance"],
                         {"currency": fixed.CURRENCIES, "account_type": fixed.ACCOUNT_TYPES}),
    "company_metrics": (["customer_id"], ["valuation", "arr_reported"], {}),
}


def _staging_checks() -> list[Check]:
    checks: list[Check] = []
    for name, (references, amounts, codes) in _STAGING_RULES.items():
        entity = ENTITIES[name]
        checks.append(unique(entity.table, entity.key))
        if entity.key_required:
            checks.append(not_null(entity.table, entity.key))
        checks += [not_null(entity.table, column) for column in references]
        checks += [not_null(entity.table, column, WARN) for column in amounts]
        checks += [accepted(entity.table, column, values, WARN) for column, values in codes.items()]
    return checks


def _keyed(model: str, key: str) -> list[Check]:
    return [unique(model, key), not_null(model, key)]


def _reference(model: str, column: str, parent: str) -> list[Check]:
    return [not_null(model, column), relationship(model, column, parent)]


_FACILITIES = ENTITIES["credit_facilities"].table

MODEL_CHECKS: list[Check] = [
    *_keyed("int_arr_per_customer", "customer_id"),
    *_keyed("int_facility_utilization", "facility_id"),
    relationship("int_facility_utilization", "customer_id", _FACILITIES),
    accepted("int_facility_utilization", "is_orphaned", [True, False]),
    *_keyed("int_fx_rates_normalized", "transaction_id"),
    not_null("int_fx_rates_normalized", "customer_id"),
    accepted("int_fx_rates_normalized", "is_orphaned", [False]),
    *_reference("int_repayment_schedule", "facility_id", _FACILITIES),
    not_null("int_repayment_schedule", "customer_id"),
    *_keyed("dim_customers", "customer_id"),
    accepted("dim_customers", "is_orphaned", [False]),
    *_keyed("dim_credit_facilities", "facility_id"),
    *_reference("dim_credit_facilities", "customer_id", "dim_customers"),
    accepted("dim_credit_facilities", "is_orphaned", [True, False]),
    unique("fct_drawdowns", "drawdown_id"),
    *_reference("fct_drawdowns", "facility_id", "dim_credit_facilities"),
    *_reference("fct_drawdowns", "customer_id", "dim_customers"),
    accepted("fct_drawdowns", "is_orphaned", [True, False]),
    *_keyed("fct_repayments", "repayment_id"),
    not_null("fct_repayments", "drawdown_id"),
    *_reference("fct_repayments", "facility_id", "dim_credit_facilities"),
    *_reference("fct_repayments", "customer_id", "dim_customers"),
    accepted("fct_repayments", "is_orphaned", [True, False]),
    *_keyed("fct_fx_transactions", "transaction_id"),
    *_reference("fct_fx_transactions", "customer_id", "dim_customers"),
    accepted("fct_fx_transactions", "is_orphaned", [True, False]),
]

# Checks the written rules ask for beyond the attached ones.
EXTRA_CHECKS: list[Check] = [
    holds("int_repayment_schedule", "installment_amount", "installment_amount > 0"),
    holds("dim_customers", "arr_variance_pct", f"abs(arr_variance_pct) <= {fixed.ARR_VARIANCE_LIMIT_PCT}"),
]

SUITE: list[Check] = [*_staging_checks(), *MODEL_CHECKS]


# --- running checks -----------------------------------------------------------

def _violations(check: Check) -> Column:
    """Rows of the model that break a column check. NULL passes all but not_null."""
    column = F.col(check.column)
    if check.test == "not_null":
        broken = column.isNull()
    elif check.test == "accepted_values":
        broken = ~column.isin(*check.values)
    else:
        broken = ~F.expr(check.expression)
    return F.count_if(F.coalesce(broken, F.lit(False)))


def _labelled(check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(check.model).alias("model"), F.lit(check.column).alias("column"), F.lit(check.test).alias("test"),
        F.lit(check.severity).alias("severity"), failures.cast("bigint").alias("failures"))


def _column_results(table: DataFrame, checks: list[Check]) -> DataFrame:
    counted = table.agg(*[_violations(check).alias(f"c{i}") for i, check in enumerate(checks)])
    return counted.select(F.inline(F.array(*[_labelled(check, F.col(f"c{i}")) for i, check in enumerate(checks)])))


def _single_result(counted: DataFrame, check: Check) -> DataFrame:
    return counted.select(F.inline(F.array(_labelled(check, F.col("n")))))


def duplicated_values(table: DataFrame, column: str) -> DataFrame:
    """Non-null values that occur more than once."""
    return table.filter(F.col(column).isNotNull()).groupBy(column).count().filter(F.col("count") > 1)


def broken_rows(table: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Number of rows whose non-null key has no parent.

    Rows are counted per key before the anti join, so a hot key crosses the
    shuffle as one row per task.
    """
    per_key = table.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
    return broken_links(per_key, column, parent, parent_column).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n"))


def columns_read(checks: list[Check]) -> dict[str, list[str]]:
    """Per model what ``run_checks`` reads of it: checked columns, names in expressions, keys that others refer to."""
    read: dict[str, dict[str, None]] = {}
    for check in checks:
        names = [check.column, *re.findall(r"[A-Za-z_]\w*", check.expression or "")]
        read.setdefault(check.model, {}).update(dict.fromkeys(names))
        if check.parent:
            read.setdefault(check.parent[0], {})[check.parent[1]] = None
    return {model: list(names) for model, names in read.items()}


def run_checks(model: Callable[[str], DataFrame], checks: list[Check]) -> DataFrame:
    """Results of ``checks``; ``model`` gives each relation by name.

    The result has one row per check, so uniting the parts stays small
    however large the models are.
    """
    parts: list[DataFrame] = []
    for name in dict.fromkeys(check.model for check in checks):
        own = [check for check in checks if check.model == name]
        table = model(name)
        by_column = [check for check in own if check.test in BY_ROW]
        if by_column:
            parts.append(_column_results(table, by_column))
        for check in own:
            if check.test == "unique":
                repeated = duplicated_values(table, check.column).agg(F.count("*").alias("n"))
                parts.append(_single_result(repeated, check))
            elif check.test == "relationships":
                parent, parent_column = check.parent
                parts.append(_single_result(
                    broken_rows(table, check.column, model(parent), parent_column), check))
    return _with_status(reduce(lambda a, b: a.unionByName(b), parts))


def _with_status(results: DataFrame) -> DataFrame:
    status = F.when(F.col("failures") == 0, "pass").when(F.col("severity") == ERROR, "fail").otherwise("warn")
    return results.withColumn("status", status).select(*RESULT_COLUMNS)


class WriteChecks:
    """Checks whose row-wise part is counted while the models are written.

    Pass ``watch`` to ``tables.build``; each model then reports its counts with
    its write. ``results`` reads written models only for what needs a state per
    key (uniqueness, relationships) and for models that were not written.
    """

    def __init__(self, checks: list[Check]):
        self.checks = checks
        self._seen: dict[str, Observation] = {}

    def _by_row(self, model: str) -> list[Check]:
        return [check for check in self.checks if check.model == model and check.test in BY_ROW]

    def watch(self, model: str, rows: DataFrame) -> DataFrame:
        own = self._by_row(model)
        if not own:
            return rows
        self._seen[model] = Observation(f"checks of {model}")
        return rows.observe(self._seen[model], *[_violations(check).alias(f"c{i}") for i, check in enumerate(own)])

    def results(self, written: Warehouse) -> DataFrame:
        """One row per check, as ``run_checks`` gives them. Each watched model must have been written once."""
        counted = []
        for model, seen in self._seen.items():
            failures = seen.get
            counted += [(check.model, check.column, check.test, check.severity, int(failures[f"c{i}"]))
                        for i, check in enumerate(self._by_row(model))]
        taken = written.spark.createDataFrame(
            counted, "model string, column string, test string, severity string, failures bigint")
        left = [check for check in self.checks if check.test not in BY_ROW or check.model not in self._seen]
        taken = _with_status(taken)
        return taken.unionByName(run_checks(written.model, left)) if left else taken


class ChecksFailed(Exception):
    """At least one error-level check has failures."""


def require(results: DataFrame) -> None:
    """Stop the run on error-level failures; warnings only get reported."""
    failed = results.filter(F.col("status") == "fail").collect()
    if failed:
        names = ", ".join(f"{row.model}.{row.column} {row.test} ({row.failures})" for row in failed)
        raise ChecksFailed(names)


# --- sources --------------------------------------------------------------------

def freshness(spark: SparkSession, landing: str, now: Column, warn_hours: int = fixed.FRESHNESS_HOURS,
              fail_hours: int | None = None) -> DataFrame:
    """Age of the newest event per source and entity, from one scan of three columns."""
    events = spark.read.schema(ENVELOPE).parquet(f"{landing}/{RAW_ROOT}")
    newest = events.groupBy("_source", "_entity").agg(F.max("_ingested_at").alias("last_loaded_at"))
    age = F.timestamp_diff("SECOND", F.col("last_loaded_at"), now)
    status = F.when(age > warn_hours * 3600, "warn").otherwise("pass")
    if fail_hours is not None:
        status = F.when(age > fail_hours * 3600, "fail").otherwise(status)
    return newest.select(
        F.col("_source").alias("source"), F.col("_entity").alias("entity"), "last_loaded_at",
        age.alias("age_seconds"), status.alias("status"))


def landed_files(spark: SparkSession, landing: str) -> DataFrame:
    """Files per expected entity; an entity without files shows up as missing.

    Only the file listing is used: the content column is never read.
    """
    expected = spark.createDataFrame([(e.source, e.name) for e in ENTITIES.values()], "source string, entity string")
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true").load(f"{landing}/{RAW_ROOT}")
        .select(F.regexp_extract("path", r"raw_events_([a-z]+_[a-z_]+?)_(?:batch|\d{8})", 1).alias("label"))
        .groupBy("label").agg(F.count("*").alias("files"))
    )
    label = F.concat_ws("_", "source", "entity")
    return (
        expected.withColumn("label", label).join(files, "label", "left")
        .select("source", "entity", F.coalesce("files", F.lit(0)).alias("files"),
                F.when(F.col("files") > 0, "ok").otherwise("missing").alias("status"))
    )


def landed_events(spark: SparkSession, landing: str) -> DataFrame:
    """``landed_files`` with the number of events per expected entity, from a scan of the two routing columns."""
    held = spark.read.schema(ENVELOPE).parquet(f"{landing}/{RAW_ROOT}").groupBy(
        F.col("_source").alias("source"), F.col("_entity").alias("entity")).agg(F.count(F.lit(1)).alias("_events"))
    return landed_files(spark, landing).join(held, ["source", "entity"], "left").withColumn(
        "events", F.coalesce("_events", F.lit(0))).drop("_events")


# --- run summary ----------------------------------------------------------------

_FAILED = ("error", "fail", "runtime error")
_OK = ("success", "pass", "warn")


def as_run_results(results: DataFrame) -> DataFrame:
    """Check results in the form of a run log."""
    return results.select(
        F.concat_ws("_", "test", "model", "column").alias("name"), F.lit("test").alias("resource_type"), "status",
        F.concat(F.col("failures"), F.lit(" failing rows")).alias("message"))


def run_summary(run: DataFrame) -> DataFrame:
    """One row: ok and failed models and tests, and skipped nodes."""
    is_test = F.col("resource_type") == "test"
    ok, failed = F.col("status").isin(*_OK), F.col("status").isin(*_FAILED)
    return run.agg(
        F.count_if(~is_test & ok).alias("models_ok"), F.count_if(~is_test & failed).alias("models_failed"),
        F.count_if(is_test & ok).alias("tests_ok"), F.count_if(is_test & failed).alias("tests_failed"),
        F.count_if(F.col("status") == "skipped").alias("skipped"))


def run_messages(run: DataFrame, first: int | None = None) -> DataFrame:
    """Messages of failed or warning nodes, failures before warnings; all, or the ``first``."""
    noted = run.filter(F.col("status").isin(*_FAILED, "warn"))
    ordered = noted.orderBy(F.col("status") == "warn", "name")
    return (ordered if first is None else ordered.limit(first)).select(
        F.concat_ws(": ", "name", F.when(F.col("status") == "warn", "warn").otherwise(
            F.coalesce("message", "status"))).alias("message"))
