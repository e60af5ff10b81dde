"""Written tables: materialised staging, mart exports, external tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Collection, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomledger.plans.entities import ENTITIES
from loomledger.plans.marts import MART_NAMES
from loomledger.plans.warehouse import INTERMEDIATE_NAMES, Warehouse
from loomledger.sources.versions import recover_folder, replace_folder

# Keys by which facts and checks look other models up; they are written with every model that has them.
KEYS = ("facility_id", "customer_id")
# The one model above staging from which another takes more than keys; it is written whole.
READ_BY_DIMENSIONS = "int_arr_per_customer"
# Column names and types of the exported marts.
MART_SCHEMAS = {
    "dim_customers": (
        "customer_id string, company_name string, country_code string, industry string, "
        "headcount_at_application bigint, valuation_at_application decimal(18,2), arr_at_application decimal(18,2), "
        "lifetime_arr double, arr_growth_pct double, total_facility_limit decimal(38,2), "
        "total_drawn_amount decimal(38,2), primary_account_currency string, current_headcount bigint, "
        "current_valuation decimal(18,2), team_growth_pct double, valuation_increase_multiple double, "
        "arr_variance_pct double, is_orphaned boolean"
    ),
    "dim_credit_facilities": (
        "facility_id string, application_id string, customer_id string, facility_limit decimal(18,2), "
        "currency string, approval_date timestamp_ntz, maturity_date timestamp_ntz, facility_status string, "
        "interest_rate double, current_utilization_pct double, is_orphaned boolean"
    ),
    "fct_drawdowns": (
        "drawdown_id string, facility_id string, customer_id string, amount decimal(18,2), currency string, "
        "drawdown_date timestamp_ntz, purpose string, status string, days_since_facility_approval bigint, "
        "is_orphaned boolean"
    ),
    "fct_repayments": (
        "repayment_id string, drawdown_id string, facility_id string, customer_id string, "
        "scheduled_amount decimal(18,2), actual_amount decimal(18,2), currency string, due_date timestamp_ntz, "
        "actual_date timestamp_ntz, scheduled_vs_actual_lag_days bigint, status string, is_orphaned boolean"
    ),
    "fct_fx_transactions": (
        "transaction_id string, customer_id string, base_currency string, quote_currency string, "
        "currency_pair string, notional_base decimal(18,2), notional_quote decimal(18,2), effective_rate double, "
        "rate_type string, transaction_date timestamp_ntz, is_orphaned boolean"
    ),
}


def declared_schema(mart: str) -> T.StructType:
    return T.StructType.fromDDL(MART_SCHEMAS[mart])


def check_schema(mart: str, actual: T.StructType) -> None:
    """Fail before writing or registering a table that left its contract."""
    expected = [(f.name, f.dataType.simpleString()) for f in declared_schema(mart)]
    found = [(f.name, f.dataType.simpleString()) for f in actual]
    if expected != found:
        difference = sorted(set(expected) ^ set(found))
        raise ValueError(f"{mart} does not match its declared schema: {difference}")


def materialise(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """Write a table once and continue from the written copy."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def build(warehouse: Warehouse, folder: str, with_intermediate: bool = False,
          watch: Callable[[str, DataFrame], DataFrame] | None = None,
          models: Collection[str] | None = None, columns: Mapping[str, Collection[str]] | None = None) -> Warehouse:
    """Write all staging tables and marts under ``folder``, or only ``models``.

    Each raw payload is parsed once per run; marts are planned over written
    staging, and facts look keys up in the written dimensions. Intermediate
    models stay lazy views unless asked for, which pays when checks read them
    several times. ``watch`` gets every model by name before it is written
    (``quality.WriteChecks.watch``). With ``models`` the tables that ``warehouse`` holds
    are kept, and all other models stay lazy with the columns that are asked of them.

    ``columns`` names the models that a job reads and what it reads of each: an entity is then
    staged once with the columns that all of them need, and of the other models only the
    named columns are written. Names that are no column of a model are passed over.
    """
    spark = warehouse.spark
    watch = watch or (lambda _, rows: rows)

    def put(kind: str, name: str, rows: DataFrame) -> DataFrame:
        return materialise(spark, watch(name, rows), f"{folder}/{kind}/{name}")

    if models is not None:
        built = Warehouse(spark, warehouse.raw, warehouse.now, warehouse.tables, warehouse.strict)
        for name in models:
            kind = "marts" if name in MART_NAMES else "intermediate" if name in INTERMEDIATE_NAMES else "staging"
            built.tables[name] = put(kind, name, built.model(name))
        return built
    if columns is not None:
        built = warehouse.prepared(
            lambda rows, name: put("staging", name, rows), lambda of: [of.model(name, *asked) for name, asked in columns.items()])
        for kind, names in (("intermediate", INTERMEDIATE_NAMES), ("marts", MART_NAMES)):
            for name in names:
                if name in columns and name not in built.tables:
                    rows = built.model(name, *columns[name])
                    if name != READ_BY_DIMENSIONS:
                        rows = rows.select(*[column for column in rows.columns if column in columns[name] or column in KEYS])
                    built.tables[name] = put(kind, name, rows)
        return built
    built = Warehouse(spark, warehouse.raw, warehouse.now, strict=warehouse.strict)
    for name, entity in ENTITIES.items():
        built.tables[entity.table] = put("staging", entity.table, warehouse.staged(name))
    if with_intermediate:
        for name in INTERMEDIATE_NAMES:
            built.tables[name] = put("intermediate", name, built.model(name))
    for mart in MART_NAMES:
        built.tables[mart] = put("marts", mart, built.model(mart))
    return built


def export_mart(df: DataFrame, mart: str, folder: str) -> int:
    """Replace one mart's Parquet dataset; the row count is observed while
    writing, so the data is not scanned again.

    The new files are written beside the old and put in their place when they are
    complete: a run that dies leaves the mart as it was.
    """
    check_schema(mart, df.schema)
    spark, target = df.sparkSession, f"{folder.rstrip('/')}/{mart}"
    recover_folder(spark, target)
    draft = f"{folder.rstrip('/')}/.{mart}-{uuid.uuid4().hex}"
    counted = Observation(f"export {mart}")
    df.observe(counted, F.count(F.lit(1)).alias("rows")).write.option("compression", "snappy").parquet(draft)
    rows = int(counted.get["rows"])
    replace_folder(spark, draft, target)
    return rows


def export_marts(warehouse: Warehouse, folder: str) -> dict[str, int]:
    return {mart: export_mart(warehouse.model(mart), mart, folder) for mart in MART_NAMES}


def export_by_day(df: DataFrame, path: str, day_of: str) -> None:
    """Export under year/month/day folders, replacing only the days present."""
    dated = df.withColumns({"year": F.year(day_of), "month": F.month(day_of), "day": F.dayofmonth(day_of)})
    (
        dated.hint("rebalance", "year", "month", "day")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy").partitionBy("year", "month", "day").parquet(path)
    )


def register_external(spark: SparkSession, mart: str, path: str, table: str | None = None) -> DataFrame:
    """Register an exported mart as an external table after checking its files.

    A table of that name is replaced, so that it reads the folder named last;
    files are never dropped with an external table.
    """
    check_schema(mart, spark.read.parquet(path).schema)
    name = table or mart
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({MART_SCHEMAS[mart]}) USING PARQUET LOCATION '{path}'"
    )
    return spark.table(name)
