"""Quarantine, shared folder, evidence for minor units, replaced external tables, comparison digits."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from support import T0, envelopes

from loomledger import session
from loomledger.plans import quality as q
from loomledger.plans import strict
from loomledger.plans.entities import ENTITIES
from loomledger.plans.staging import malformed_counts, quarantined, stage
from loomledger.testbed.results import comparable


def test_malformed_payloads_are_quarantined_and_make_no_row(spark):
    raw = envelopes(spark, "drawdowns", [
        (T0, 1, "b1", '{"drawdown_id":"D4","amount":5'), (T0.replace(day=12), 1, "b2", "oops"),
        (T0, 1, "b3", {"amount": 7}), (T0, 1, "b4", {"drawdown_id": "D1", "amount": 3})])
    entity = ENTITIES["drawdowns"]
    rows = {row.drawdown_id: float(row.amount) for row in stage(raw, entity).collect()}
    assert rows == {None: 7.0, "D1": 3.0}
    assert sorted(r.data for r in quarantined(raw, entity).collect()) == sorted(["oops", '{"drawdown_id":"D4","amount":5'])
    counts = {r.day: r.malformed for r in malformed_counts(raw, entity).collect()}
    assert counts == {T0.date(): 1, date(T0.year, T0.month, 12): 1}


class _Elsewhere:
    """A session on a cluster that names no shared folder."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return default

    class sparkContext:
        master = "spark://host:7077"

        @staticmethod
        def getConf():
            return {}


def test_a_cluster_without_shared_folder_is_an_error(spark):
    with pytest.raises(RuntimeError):
        session.shared_folder(_Elsewhere, "x")
    assert session.shared_folder(spark, "x") != session.shared_folder(spark, "x")


def test_one_amount_is_no_evidence_for_minor_units(spark):
    raw = envelopes(spark, "invoices", [(T0, 1, "b", {"invoice_id": "I1", "amount": 12000})])
    assert [float(r.amount) for r in strict.stage_strict(raw, ENTITIES["invoices"]).collect()] == [12000.0]


def test_all_messages_by_default(spark):
    run = spark.createDataFrame([(f"t{i:02}", "test", "fail", "boom") for i in range(30)], "name string, resource_type string, status string, message string")
    assert q.run_messages(run).count() == 30 and q.run_messages(run, 5).count() == 5


def test_small_differences_show_in_compared_results(spark):
    df = spark.createDataFrame([(0.006689, datetime(2024, 1, 2, 3, 4, 5, 250000))], "a double, t timestamp_ntz")
    moved = df.select((F.col("a") + 1e-9).alias("a"), (F.col("t") + F.expr("interval 1 millisecond")).alias("t"))
    first, second = comparable(df).first(), comparable(moved).first()
    assert first.a != second.a and first.t == "2024-01-02 03:04:05.250000" != second.t
    assert comparable(df.select((F.col("a") * (1 + 1e-13)).alias("a"))).first().a == first.a
    assert comparable(spark.createDataFrame([(Decimal("1.10"),)], "m decimal(18,2)")).first().m == 1.1
