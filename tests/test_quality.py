"""The declared suite, severities and invariants of the built warehouse."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from loomledger.functions import columns as c
from loomledger.functions import fixed
from loomledger.plans import quality as q
from loomledger.plans.entities import ENTITIES
from loomledger.testbed import landing as ld


def test_the_declared_suite_is_complete():
    kinds = Counter(check.test for check in q.SUITE)
    assert kinds == {"unique": 17, "not_null": 47, "accepted_values": 24, "relationships": 8}
    severity = Counter((check.test, check.severity) for check in q.SUITE)
    assert severity[("not_null", "error")] == 37 and severity[("not_null", "warn")] == 10
    assert severity[("accepted_values", "warn")] == 17 and severity[("accepted_values", "error")] == 7


def test_severities_and_null_rules(spark):
    parent = spark.createDataFrame([("a",), ("b",)], "k string")
    child = spark.createDataFrame([("a", 1), ("a", -1), ("x", 2), (None, None)], "k string, n int")
    tables = {"parent": parent, "child": child}
    results = q.run_checks(tables.__getitem__, [
        q.unique("child", "k"), q.not_null("child", "k"), q.not_null("child", "n", q.WARN),
        q.accepted("child", "k", ["a"], q.WARN), q.relationship("child", "k", "parent"), q.holds("child", "n", "n > 0"),
        q.unique("parent", "k")])
    rows = [(r.model, r.test, r.failures, r.status) for r in results.collect()]
    assert rows and set(rows) == {
        ("child", "unique", 1, "fail"), ("child", "not_null", 1, "fail"), ("child", "not_null", 1, "warn"),
        ("child", "accepted_values", 1, "warn"), ("child", "relationships", 1, "warn"),
        ("child", "expression_is_true", 1, "warn"), ("parent", "unique", 0, "pass")}
    with pytest.raises(q.ChecksFailed, match="child.k unique"):
        q.require(results)
    q.require(results.filter("status <> 'fail'"))


def test_run_summary_counts(spark):
    run = spark.createDataFrame(
        [("m1", "model", "success", None), ("m2", "model", "error", "boom"), ("t1", "test", "pass", None),
         ("t2", "test", "success", None), ("t3", "test", "warn", None), ("t4", "test", "fail", "2 failing rows"),
         ("t5", "test", "skipped", None)], "name string, resource_type string, status string, message string")
    row = q.run_summary(run).first()
    assert tuple(row) == (1, 1, 3, 1, 1)
    assert [r.message for r in q.run_messages(run).collect()] == ["m2: boom", "t4: 2 failing rows", "t3: warn"]


def test_freshness_levels(spark, sf_dir):
    landing = ld.fully_landed(spark, sf_dir)
    assert {r.status for r in q.freshness(spark, landing, c.ntz("2024-01-31 00:00:00")).collect()} == {"pass"}
    assert {r.status for r in q.freshness(spark, landing, c.ntz("2024-02-02 00:00:00")).collect()} == {"warn"}
    late = q.freshness(spark, landing, c.ntz("2024-02-10 00:00:00"), fail_hours=48)
    assert {r.status for r in late.collect()} == {"fail"}


@pytest.fixture(scope="module")
def built(spark, sf_dir):
    return ld.built_warehouse(spark, sf_dir)


def test_facts_keep_the_grain_of_their_staging(built):
    for fact, entity in (("fct_drawdowns", "drawdowns"), ("fct_repayments", "repayments"),
                         ("fct_fx_transactions", "fx_transactions"), ("dim_credit_facilities", "credit_facilities")):
        assert built.model(fact).count() == built.staged(entity).count()


def test_orphans_are_the_complement_of_inner_joins(built):
    facts = built.fct_drawdowns()
    joined = facts.join(built.dim_credit_facilities().select("facility_id"), "facility_id").join(
        built.dim_customers().select("customer_id"), "customer_id")
    assert facts.filter("NOT is_orphaned").count() == joined.count()


def test_totals_agree(built):
    drawn = built.staged("drawdowns").filter("status = 'completed'").groupBy("customer_id").agg(F.sum("amount").alias("s"))
    off = built.dim_customers().join(drawn, "customer_id", "left").filter(
        F.col("total_drawn_amount") != F.coalesce("s", F.lit(0)))
    assert off.count() == 0
    assert built.dim_customers().filter("arr_variance_pct <> 0").count() > 0


def test_cleansed_ranges(built):
    for entity in ENTITIES.values():
        table = built.staged(entity.name)
        for column in [name for name in entity.columns if name.endswith("currency")]:
            assert table.filter(~F.col(column).isin(*fixed.CURRENCIES)).count() == 0
    assert built.staged("drawdowns").filter("amount < 0").count() == 0
    assert built.staged("credit_facilities").filter("facility_limit < 0").count() == 0
    assert built.staged("account_balances").filter("balance < 0").count() == 0


def test_written_and_lazy_models_agree(spark, sf_dir, built):
    lazy = ld.warehouse(spark, sf_dir)
    for mart in ("dim_customers", "fct_drawdowns"):
        assert built.model(mart).exceptAll(lazy.model(mart)).count() == 0
