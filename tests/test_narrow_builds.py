"""Findings of the third round, repeated: checks and exports stage and write only what they read."""

import pytest

from loomledger.plans import quality as q
from loomledger.plans.entities import ENTITIES
from loomledger.plans.marts import MART_NAMES
from loomledger.plans.warehouse import INTERMEDIATE_NAMES
from loomledger.sources import tables
from loomledger.testbed import landing as ld

ALL = [*q.SUITE, *q.EXTRA_CHECKS]


def of(test):
    return [check for check in ALL if check.test == test]


@pytest.mark.parametrize("checks", [of("unique"), of("not_null"), of("accepted_values"), ALL], ids=["unique", "not_null", "accepted", "all"])
def test_checks_over_what_they_read_are_those_over_the_whole_warehouse(spark, sf_dir, tmp_path, checks):
    read = q.columns_read(checks)
    narrow = tables.build(ld.warehouse(spark, sf_dir), str(tmp_path), columns=read)
    whole = q.run_checks(ld.built_warehouse(spark, sf_dir).model, checks)
    found = q.run_checks(narrow.model, checks)
    assert found.exceptAll(whole).isEmpty() and whole.exceptAll(found).isEmpty()
    # All that is checked is written, and of the models above staging nothing else but the keys.
    assert set(read) <= set(narrow.tables)
    for name in {*INTERMEDIATE_NAMES, *MART_NAMES} & set(read) - {tables.READ_BY_DIMENSIONS}:
        assert set(narrow.tables[name].columns) <= {*read[name], *tables.KEYS}, name
    for entity in ENTITIES.values():
        held = narrow.tables.get(entity.table)
        assert held is None or checks is ALL or set(held.columns) < {*entity.columns, "_ingested_at", "_schema_version"}


def test_uniqueness_leaves_most_of_staging_unparsed(spark, sf_dir, tmp_path):
    narrow = tables.build(ld.warehouse(spark, sf_dir), str(tmp_path), columns=q.columns_read(of("unique")))
    held = set(narrow.tables[ENTITIES["repayments"].table].columns)
    assert held == {"repayment_id", "facility_id", "customer_id", "_ingested_at", "_schema_version"}
    assert set(narrow.tables[ENTITIES["invoices"].table].columns) == {"invoice_id", "_ingested_at", "_schema_version"}


def test_every_model_can_be_had_in_part(spark, sf_dir):
    built = ld.built_warehouse(spark, sf_dir)
    for name in MART_NAMES:
        for column in built.model(name).columns:
            part = ld.warehouse(spark, sf_dir).model(name, column).select(column)
            assert part.schema[column].dataType == built.model(name).schema[column].dataType, (name, column)
    for name, column in [("fct_drawdowns", "days_since_facility_approval"), ("dim_customers", "arr_variance_pct"),
                         ("dim_customers", "team_growth_pct"), ("dim_credit_facilities", "facility_status"),
                         ("fct_fx_transactions", "currency_pair"), ("int_fx_rates_normalized", "quote_amount")]:
        whole, part = built.model(name).select(column), ld.warehouse(spark, sf_dir).model(name, column).select(column)
        assert part.exceptAll(whole).isEmpty() and whole.exceptAll(part).isEmpty(), (name, column)


def test_a_narrow_dimension_does_not_answer_for_what_it_lacks(spark, sf_dir, tmp_path):
    read = {"dim_credit_facilities": ["facility_id"], "fct_drawdowns": ["days_since_facility_approval"]}
    narrow = tables.build(ld.warehouse(spark, sf_dir), str(tmp_path), columns=read)
    assert "approval_date" not in narrow.tables["dim_credit_facilities"].columns
    found = narrow.fct_drawdowns().select("days_since_facility_approval")
    whole = ld.built_warehouse(spark, sf_dir).fct_drawdowns().select("days_since_facility_approval")
    assert found.exceptAll(whole).isEmpty() and whole.exceptAll(found).isEmpty()


def test_exported_marts_are_written_once(spark, sf_dir, tmp_path):
    staged = ld.warehouse(spark, sf_dir).prepared(
        lambda rows, name: tables.materialise(spark, rows, f"{tmp_path}/staging/{name}"), lambda of: [of.model(m) for m in MART_NAMES])
    assert ENTITIES["invoices"].table not in staged.tables and not set(MART_NAMES) & set(staged.tables)
    counts = tables.export_marts(staged, str(tmp_path / "out"))
    built = ld.built_warehouse(spark, sf_dir)
    assert counts == {mart: built.model(mart).count() for mart in MART_NAMES}
    for mart in MART_NAMES:
        written = spark.read.parquet(f"{tmp_path}/out/{mart}")
        assert written.exceptAll(built.model(mart)).isEmpty() and built.model(mart).exceptAll(written).isEmpty(), mart
