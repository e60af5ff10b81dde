"""Early sums below joins, exports that survive a crash, listing of days, rows without a key."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from support import T0, envelopes

from loomledger.plans import reports
from loomledger.plans.entities import ENTITIES
from loomledger.plans.units import written
from loomledger.plans.warehouse import Warehouse
from loomledger.sources import envelope, tables
from loomledger.sources.versions import recover_folder

REPAYMENTS = "repayment_id string, facility_id string, customer_id string, due_date timestamp_ntz, actual_date timestamp_ntz"


def repayments(spark):
    """A customer with most of the rows, unknown parents, missing keys."""
    rows = [(f"R{n}", f"F{n % 7}", "C1", T0, T0 + timedelta(days=n % 11) if n % 3 else None) for n in range(900)]
    rows += [(f"S{n}", f"F{n % 9}", f"C{n % 5}", T0, T0) for n in range(60)] + [("T1", None, "C1", T0, T0), ("T2", "F1", None, T0, T0)]
    return spark.createDataFrame(rows, REPAYMENTS)


def test_early_sums_equal_sums_over_the_fact(spark):
    rows = repayments(spark)
    facilities = spark.createDataFrame([(f"F{n}",) for n in range(6)], "facility_id string")
    customers = spark.createDataFrame([(f"C{n}", f"Firm {n % 2}") for n in range(4)], "customer_id string, company_name string")
    flags = (rows.join(facilities.withColumn("f", F.lit(True)), "facility_id", "left")
             .join(customers.select("customer_id").withColumn("c", F.lit(True)), "customer_id", "left"))
    fact = flags.withColumns({"is_orphaned": F.col("f").isNull() | F.col("c").isNull(),
                              "scheduled_vs_actual_lag_days": F.datediff("actual_date", "due_date").cast("bigint")})
    early = reports.repayment_watchlist_staged(rows, facilities, customers)
    assert early.collect() == reports.repayment_watchlist(fact, customers).collect() and early.count() == 2


def test_no_join_sees_more_than_a_row_per_pair(spark):
    """With the session's skew settings off and no broadcast, rows are summed below every join."""
    before = {name: spark.conf.get(name) for name in ("spark.sql.adaptive.skewJoin.enabled", "spark.sql.adaptive.forceOptimizeSkewedJoin")}
    try:
        for name in before:
            spark.conf.set(name, "false")
        facilities = spark.createDataFrame([("F1",)], "facility_id string")
        customers = spark.createDataFrame([("C1", "Firm")], "customer_id string, company_name string")
        frame = reports.repayment_watchlist_staged(repayments(spark), facilities, customers)
        tree = frame._jdf.queryExecution().optimizedPlan().toString().splitlines()
        joins = [n for n, line in enumerate(tree) if "Join " in line]
        first = next(n for n, line in enumerate(tree) if "Aggregate [facility_id" in line)
        assert len(joins) == 2 and all(n < first for n in joins)  # the tree prints children last
        assert not any("Join" in line for line in tree[first:])
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def drawdown_mart(spark, ids):
    schema = tables.declared_schema("fct_drawdowns")
    rows = spark.createDataFrame([(i,) for i in ids], "drawdown_id string")
    return rows.select("drawdown_id", *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields[1:]])


def test_a_failed_export_leaves_the_old_mart(spark, tmp_path):
    folder = str(tmp_path)
    assert tables.export_mart(drawdown_mart(spark, ["a", "b"]), "fct_drawdowns", folder) == 2
    bad = drawdown_mart(spark, ["c", "d"]).withColumn("drawdown_id", F.when(F.col("drawdown_id") == "d", F.raise_error(F.lit("stop")))
                                                      .otherwise(F.col("drawdown_id")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        tables.export_mart(bad, "fct_drawdowns", folder)
    read = lambda: sorted(r[0] for r in spark.read.parquet(f"{folder}/fct_drawdowns").select("drawdown_id").collect())
    assert read() == ["a", "b"]
    # A run that died after setting the old mart aside.
    (tmp_path / "fct_drawdowns").rename(tmp_path / ".fct_drawdowns-retired")
    recover_folder(spark, f"{folder}/fct_drawdowns")
    assert read() == ["a", "b"]
    assert tables.export_mart(drawdown_mart(spark, ["e"]), "fct_drawdowns", folder) == 1 and read() == ["e"]


def test_a_bounded_read_lists_only_its_days(spark, tmp_path):
    entity, landing = ENTITIES["drawdowns"], str(tmp_path)
    envelope.write_raw_events(envelopes(spark, "drawdowns", [
        (T0 + timedelta(days=n), 1, f"b{n}", {"drawdown_id": f"D{n}"}) for n in range(3)]), landing, entity)
    for n in range(1000):
        day = date(2022, 1, 1) + timedelta(days=n)
        (tmp_path / "raw_events" / f"year={day.year}" / f"month={day.month}" / f"day={day.day}").mkdir(parents=True, exist_ok=True)
    folders = envelope.day_folders(spark, landing, T0.date(), T0.date() + timedelta(days=1))
    assert [f.split("raw_events/")[1] for f in folders] == ["year=2026/month=1/day=10", "year=2026/month=1/day=11"]
    read = envelope.read_raw_events(spark, landing, entity, T0.date(), T0.date() + timedelta(days=1))
    assert sorted(r["_batch_id"] for r in read.collect()) == ["b0", "b1"] and len(read.inputFiles()) == 2
    assert envelope.read_raw_events(spark, landing, entity, date(2030, 1, 1)).collect() == []
    assert len(envelope.day_folders(spark, landing, None, None)) == 1003
    assert envelope.read_raw_events(spark, landing, entity, until=date(2025, 1, 1)).count() == 0


def test_reports_that_share_entities_stage_each_once(spark):
    asked = []

    def raw(name):
        asked.append(name)
        rows = [(T0, 1, "b", {ENTITIES[name].key: f"K{n}", "customer_id": f"C{n % 3}", "facility_id": f"K{n % 2}", "status": "approved"})
                for n in range(6)]
        return envelopes(spark, name, rows)

    def census(house):
        return reports.orphan_census(*[house.orphan_flags(name) for name in ("drawdowns", "repayments", "fx_transactions")])

    lazy, tables_written = Warehouse(spark, raw), {}

    def write(rows, name):
        tables_written[name] = rows.columns
        return written(rows, name)

    ready = lazy.prepared(write, census)
    assert sorted(tables_written) == sorted(ENTITIES[n].table for n in (
        "drawdowns", "repayments", "fx_transactions", "credit_facilities", "loan_applications"))
    assert "amount" not in tables_written["stg_lending__drawdowns"] and "facility_id" in tables_written["stg_lending__drawdowns"]
    asked.clear()
    result = census(ready)
    assert asked == [] and "from_json" not in result._jdf.queryExecution().optimizedPlan().toString()
    assert result.collect() == census(Warehouse(spark, raw)).collect()
