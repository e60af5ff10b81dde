"""Findings of the fourth round: wide landings in compiled methods, landing where the rows lie."""

from datetime import datetime

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from loomledger.functions.draws import Draws
from loomledger.generate import entities as g
from loomledger.generate.dirt import generate
from loomledger.plans import strict, units
from loomledger.plans.entities import ENTITIES
from loomledger.session import COMPILED_BYTES, HUGE_METHOD, compiled_methods
from loomledger.sources.envelope import DAY_COLUMNS, write_raw_events
from loomledger.testbed import landing as ld


def test_landing_packs_wide_rows_in_methods_that_are_compiled(spark, tmp_path, monkeypatch):
    limits, write = [], DataFrameWriter.parquet

    def noted(self, *args, **kwargs):
        limits.append(spark.conf.get(HUGE_METHOD))
        return write(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    before = spark.conf.get(HUGE_METHOD)
    plan = g.Plan(seed=7)
    events = generate(g.customers(spark.range(5), "id", plan), "invoices", plan, by_day=True)
    write_raw_events(events, str(tmp_path), ENTITIES["invoices"])
    assert limits == [str(COMPILED_BYTES)] and spark.conf.get(HUGE_METHOD) == before


def test_the_limit_comes_back_after_a_failure(spark):
    before = spark.conf.get(HUGE_METHOD)
    with pytest.raises(ZeroDivisionError), compiled_methods(spark):
        raise ZeroDivisionError
    assert spark.conf.get(HUGE_METHOD) == before


def test_draws_are_those_of_the_decimal_text(spark):
    draws = Draws(42, "row", F.col("id"), F.when(F.col("id") % 3 != 0, F.col("id")))
    text = F.conv(F.substring(draws.digest("x"), 1, 13), 16, 10).cast("double") / F.lit(4503599627370496.0)
    rows = spark.range(500).select(draws.uniform("x").alias("now"), text.alias("text"))
    assert rows.filter(~F.col("now").eqNullSafe(F.col("text"))).isEmpty()
    assert rows.filter((F.col("now") < 0) | (F.col("now") >= 1)).isEmpty()


def stored_in_many_files(spark, sf_dir, folder):
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").repartition(24).write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


@pytest.mark.parametrize("name", ["drawdowns", "repayments"])
def test_rows_of_a_table_in_many_splits_are_landed_where_they_lie(spark, sf_dir, tmp_path, name):
    tables = stored_in_many_files(spark, sf_dir, tmp_path / "tables")
    events = ld.packed_events(spark, tables, name, by_day=True, in_place=True)
    assert "Exchange" not in events._jdf.queryExecution().executedPlan().toString()
    plain = ld.packed_events(spark, tables, name)
    assert events.columns == [*plain.columns, *DAY_COLUMNS]
    landed = ld.raw_events(spark, tables, name)
    assert landed.count() == plain.count() > 0
    assert landed.exceptAll(plain).isEmpty() and plain.exceptAll(landed).isEmpty()


def test_rows_of_a_table_in_few_splits_are_still_dealt(spark, sf_dir):
    events = ld.packed_events(spark, sf_dir, "drawdowns", by_day=True, in_place=True)
    assert "Exchange" in events._jdf.queryExecution().executedPlan().toString()


def test_units_are_inferred_without_a_shuffle_of_the_rows(spark, sf_dir):
    entity = ENTITIES["repayments"]
    rows = strict.parsed_once(ld.raw_events(spark, sf_dir, "repayments"), entity)
    scaled = units.to_major_units(rows, entity)
    plan = scaled._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and plan.count("BroadcastHashJoin") == 2
    assert scaled.count() == rows.count()


def test_large_batches_are_units_of_their_own(spark):
    at = datetime(2026, 1, 10)
    batches = ["a"] * 9 + ["b"] * 3 + [None] * 9
    rows = spark.createDataFrame([(at, batch, n) for n, batch in enumerate(batches)], "_ingested_at timestamp_ntz, _batch_id string, n int")
    found = {row["n"]: row["_unit"] for row in units.with_unit(rows, 8).collect()}
    assert found == {n: "batch a" if batch == "a" else "" for n, batch in enumerate(batches)}
