"""The physical plans have the shape they should have at scale."""

import re

import pytest
from pyspark.sql import functions as F

from loomledger.plans.marts import MART_NAMES
from loomledger.testbed import landing as ld


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def warehouse(spark, sf_dir):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    yield ld.warehouse(spark, sf_dir)
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.fixture(scope="module")
def no_broadcast(spark):
    """Plans as they look once every side is past the broadcast threshold."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_dedup_limits_rows_per_key_before_the_shuffle(warehouse):
    plan = plan_of(warehouse.staged("drawdowns"))
    partial, exchange = plan.index("row_number(), 1, Partial"), plan.index("Exchange hashpartitioning(drawdown_id")
    assert exchange < partial  # the tree prints children last
    assert plan.count("Exchange ") == 1


def test_scan_pushes_filters_and_prunes_columns(warehouse):
    plan = plan_of(warehouse.staged("drawdowns").select("drawdown_id", "amount"))
    pushed = re.search(r"PushedFilters: \[([^\]]*)", plan).group(1)
    assert "EqualTo(_entity,drawdowns)" in pushed and "IsNotNull(data)" in pushed


def test_payload_is_parsed_once_and_only_for_the_columns_used(warehouse):
    plan = plan_of(warehouse.staged("loan_applications", "status"))
    assert plan.count("from_json(") == 1
    assert "StructField(industry" not in plan


def test_day_bounds_prune_partitions(spark, sf_dir, warehouse):
    from datetime import date

    plan = plan_of(ld.raw_events(spark, sf_dir, "drawdowns", date(2024, 1, 2), date(2024, 1, 3)))
    partition_filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan).group(1)
    assert "year" in partition_filters and "day" in partition_filters


@pytest.mark.parametrize("mart", MART_NAMES)
def test_no_cartesian_products_or_python(warehouse, mart):
    plan = plan_of(warehouse.model(mart))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Exchange SinglePartition"):
        assert operator not in re.sub(r"Subquery.*?FileScan[^\n]*", "", plan, flags=re.S), operator


def test_customer_dimension_shuffles_each_input_by_customer_once(warehouse, no_broadcast):
    plan = plan_of(warehouse.dim_customers())
    # applications, ARR, limits, draws, balances, metrics: one exchange each.
    assert len(re.findall(r"Exchange hashpartitioning\(customer_id#\d+, \d+\)", plan)) == 6
    assert plan.count("SortMergeJoin") == 5


def test_facility_merge_adds_no_exchange(warehouse, no_broadcast):
    plan = plan_of(warehouse.facility_utilization())
    # one for each dedup, one for the drawn totals; the outer join reuses them
    assert plan.count("Exchange hashpartitioning") == 3
    assert "FullOuter" in plan


def test_only_bounded_sides_are_broadcast_by_hint(warehouse, no_broadcast):
    for mart in ("fct_drawdowns", "fct_repayments", "fct_fx_transactions", "dim_credit_facilities"):
        assert "BroadcastHashJoin" not in plan_of(warehouse.model(mart))
    # the EUR rate list, bounded by the currency list
    assert plan_of(warehouse.dim_customers()).count("BroadcastHashJoin") == 1


def test_top_k_is_taken_per_task(warehouse):
    from loomledger.plans import reports

    plan = plan_of(reports.top_customers(warehouse.dim_customers(), "lifetime_arr", 5))
    assert "TakeOrderedAndProject(limit=5" in plan


def test_hot_and_null_keys_stay_whole(spark):
    """A third of the rows on one customer, another third on NULL."""
    from loomledger.operators import keys

    fact = spark.range(0, 30000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.lit(None)).otherwise(
            F.concat(F.lit("c"), F.col("id") % 500)).alias("customer_id"))
    parents = spark.range(0, 250).select(F.concat(F.lit("c"), F.col("id")).alias("customer_id")).union(
        spark.sql("SELECT 'hot' AS customer_id"))
    flagged = keys.with_parent(fact, parents, "customer_id", "found")
    counts = {(row.found, row.customer_id is None): row["count"] for row in flagged.groupBy(
        "found", (F.col("customer_id").isNull()).alias("n")).count().select(
            "found", F.when(F.col("n"), F.lit(None)).otherwise("x").alias("customer_id"), "count").collect()}
    brute = sum(1 for i in range(30000) if i % 3 == 0 or (i % 3 == 2 and i % 500 < 250))
    assert counts[(True, False)] == brute
    assert counts[(False, True)] == 10000 and sum(counts.values()) == 30000


def test_a_hot_parent_key_is_split_at_run_time(spark):
    """Thresholds are lowered so that a small hot key counts as skew."""
    from loomledger.plans import marts

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        rows = spark.range(0, 200000, numPartitions=16).select(
            F.concat(F.lit("D"), F.col("id")).alias("drawdown_id"),
            F.when(F.col("id") % 3 == 0, "F7").otherwise(F.concat(F.lit("F"), F.col("id") % 5000)).alias("facility_id"),
            F.concat(F.lit("C"), F.col("id") % 900).alias("customer_id"),
            F.lit(1).cast("decimal(18,2)").alias("amount"), F.lit("EUR").alias("currency"),
            F.lit("2026-01-05").cast("timestamp_ntz").alias("drawdown_date"), F.lit(None).cast("string").alias("purpose"),
            F.lit("completed").alias("status"))
        facilities = spark.range(0, 4000).select(
            F.concat(F.lit("F"), F.col("id")).alias("facility_id"), F.lit("2026-01-01").cast("timestamp_ntz").alias("approval_date"))
        customers = spark.range(0, 800).select(F.concat(F.lit("C"), F.col("id")).alias("customer_id"))
        fact = marts.fct_drawdowns(rows, facilities, customers)
        total = fact.groupBy("is_orphaned").count()
        counts = {row.is_orphaned: row["count"] for row in total.collect()}
        final_plan = plan_of(total)
    finally:
        for key in settings:
            spark.conf.unset(key)
    linked = sum(1 for i in range(200000) if (i % 3 == 0 or i % 5000 < 4000) and i % 900 < 800)
    assert counts == {False: linked, True: 200000 - linked}
    assert "skew=true" in final_plan
