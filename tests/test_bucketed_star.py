"""Facts over bucketed tables: nothing of a fact moves, heavy keys and missing keys are kept, results stay."""

import re

import pytest
from pyspark.sql import functions as F

from loomledger.plans import marts
from loomledger.plans import quality as q
from loomledger.plans.colocated import SETTINGS, BucketedStar
from loomledger.plans.warehouse import Warehouse
from loomledger.sources import bucketed, tables

DRAWDOWNS = ("drawdown_id string, facility_id string, customer_id string, amount decimal(18,2), currency string, "
             "drawdown_date timestamp_ntz, purpose string, status string")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def planned_for_buckets(spark):
    """Every side past the broadcast threshold, with the setting that buckets ask for."""
    wanted = {**SETTINGS, "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    yield
    for name in wanted:
        spark.conf.unset(name)


def drawdowns(spark):
    """A facility with a third of the rows, a third without one, the others spread; unknown parents of both kinds."""
    n = F.col("id")
    facility = F.when(n % 3 == 0, "hot").when(n % 3 == 1, F.concat(F.lit("F"), n % 400))
    return spark.range(0, 6000).select(
        F.concat(F.lit("D"), n).alias("drawdown_id"), facility.alias("facility_id"),
        F.when(n % 17 != 0, F.concat(F.lit("C"), n % 90)).alias("customer_id"), (n % 50).cast("decimal(18,2)").alias("amount"),
        F.lit("EUR").alias("currency"), F.lit("2026-01-05").cast("timestamp_ntz").alias("drawdown_date"),
        F.lit(None).cast("string").alias("purpose"), F.lit("completed").alias("status"))


def star(spark, folder, rows):
    facilities = spark.range(0, 300).select(F.concat(F.lit("F"), F.col("id")).alias("facility_id")).union(
        spark.sql("SELECT 'hot' AS facility_id")).withColumn("approval_date", F.lit("2026-01-01").cast("timestamp_ntz"))
    customers = spark.range(0, 70).select(F.concat(F.lit("C"), F.col("id")).alias("customer_id"))
    written = {name: tables.materialise(spark, df, f"{folder}/{name}") for name, df in {
        "stg_lending__drawdowns": rows, "dim_credit_facilities": facilities, "dim_customers": customers}.items()}
    return BucketedStar(Warehouse(spark, None, tables=written), f"{folder}/star", 8), written


def expected(written):
    return marts.fct_drawdowns(written["stg_lending__drawdowns"], written["dim_credit_facilities"], written["dim_customers"])


def test_rows_equal_those_of_the_plain_fact(spark, tmp_path):
    made, written = star(spark, str(tmp_path), drawdowns(spark))
    rows = sorted(made.fct_drawdowns().collect(), key=lambda row: row.drawdown_id)
    assert rows == sorted(expected(written).collect(), key=lambda row: row.drawdown_id) and len(rows) == 6000
    assert {row.is_orphaned for row in rows} == {True, False}


def test_heavy_and_missing_keys_lie_beside_the_buckets(spark, tmp_path):
    fact = star(spark, str(tmp_path), drawdowns(spark))[0].fact("drawdowns")
    assert [row.facility_id for row in fact.heavy.collect()] == ["hot"]
    assert {row.facility_id: row["count"] for row in fact.rest.groupBy("facility_id").count().collect()} == {"hot": 2000, None: 2000}
    assert fact.rows.count() == 2000


def test_a_fact_in_buckets_is_not_exchanged(spark, tmp_path, planned_for_buckets):
    made, _ = star(spark, str(tmp_path), drawdowns(spark))
    fact = made.fact("drawdowns")
    light = made.fct_drawdowns()._jdf.queryExecution().executedPlan().toString().split("Union", 1)[1]
    exchanged = "Exchange hashpartitioning(customer_id" in light
    wide = [line for line in light.splitlines() if "FileScan parquet spark_catalog" in line and "amount" in line]
    assert len(wide) == 1 and "Bucketed: true" in wide[0]
    # In buckets: from the wide scan up to the joins, no exchange; the pairs are the only rows that travel.
    path = ancestors(light.splitlines(), light.splitlines().index(wide[0]))
    assert not [line for line in path if "Exchange" in line], path
    assert exchanged
    assert fact.buckets == 8


def ancestors(lines, at):
    """The lines above a node of a plan tree, by indentation."""
    depth = lambda line: len(re.match(r"[\s:+\-|]*", line).group())
    found, level = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < level:
            found.append(line)
            level = depth(line)
    return found


def test_empty_and_all_missing(spark, tmp_path):
    nothing = drawdowns(spark).limit(0)
    assert star(spark, f"{tmp_path}/a", nothing)[0].fct_drawdowns().count() == 0
    keyless = drawdowns(spark).withColumn("facility_id", F.lit(None).cast("string"))
    rows = star(spark, f"{tmp_path}/b", keyless)[0].fct_drawdowns()
    assert rows.filter("is_orphaned").count() == rows.count() == 6000


def test_fewer_heavy_keys_than_buckets(spark):
    rows = spark.range(0, 40).select((F.col("id") % 5).cast("string").alias("k"))
    assert bucketed.heavy_keys(rows, "k", 5).count() == 0
    assert bucketed.heavy_keys(rows, "k", 6).count() == 5


def test_checks_are_counted_by_the_write(spark, tmp_path):
    """Row-wise results come from the writes: their plan reads no file."""
    rows = spark.createDataFrame([("C1", "EUR"), (None, "XXX"), (None, None)], "customer_id string, currency string")
    listed = [q.not_null("m", "customer_id"), q.accepted("m", "currency", ["EUR"], q.WARN), q.unique("m", "customer_id")]
    checks = q.WriteChecks(listed)
    written = Warehouse(spark, None, tables={"m": tables.materialise(spark, checks.watch("m", rows), f"{tmp_path}/m")})
    written.model = written.tables.get
    results = checks.results(written)
    key = lambda row: (row["model"], row["column"], row["test"])
    assert sorted(results.collect(), key=key) == sorted(q.run_checks(written.model, listed).collect(), key=key)
    scans = re.findall(r"ReadSchema: (\S+)", plan_of(results))
    assert set(scans) == {"struct<customer_id:string>"}
    empty = q.WriteChecks(listed[:2])
    tables.materialise(spark, empty.watch("m", rows.limit(0)), f"{tmp_path}/empty")
    assert [row.failures for row in empty.results(written).collect()] == [0, 0]
