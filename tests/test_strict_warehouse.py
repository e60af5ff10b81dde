"""Units of amounts by batch, and the warehouse with all recoveries."""

import random
from datetime import timedelta

from pyspark.sql import functions as F
from support import T0, envelopes

from loomledger.plans import strict, units
from loomledger.plans.entities import ENTITIES
from loomledger.plans.warehouse import Warehouse

INVOICES = ENTITIES["invoices"]


def batches(seed=1):
    """(batch, amounts as they arrive, amounts in major units)."""
    rnd = random.Random(seed)
    usual = lambda n: [round(rnd.lognormvariate(6, 0.8), 2) for _ in range(n)]
    major = [("plain1", usual(30)), ("plain2", usual(40)), ("plain3", usual(25)), ("negative", [-a for a in usual(12)])]
    out = [(name, amounts, amounts) for name, amounts in major]
    whole = [float(int(a)) + 1 for a in usual(20)]
    out.append(("truly whole", [int(a) for a in whole], whole))
    cents = usual(20)
    out.append(("whole cents", [round(a * 100) for a in cents], cents))
    text = usual(9)
    out.append(("text cents", [str(round(a * 100)) for a in text], text))
    out.append(("text major", [str(a) for a in cents], cents))
    out.append(("few cents", [50000, 60000], [50000, 60000]))
    out.append(("no amounts", [None] * 9, [None] * 9))
    far = [a * 5000 + 0.5 for a in usual(10)]
    out.append(("far off", far, far))
    return out


def raw_invoices(spark):
    rows, day = [], {}
    for number, (batch, amounts, _) in enumerate(batches()):
        at = day[batch] = T0 + timedelta(days=number // 2)  # two batches a day
        rows += [(at, 1, batch, {"invoice_id": f"{batch}-{n}", "amount": a}) for n, a in enumerate(amounts)]
    return envelopes(spark, "invoices", rows)


def test_units_are_decided_batch_by_batch(spark):
    found = {r["_unit"]: r for r in units.unit_decisions(strict.parsed_once(raw_invoices(spark), INVOICES), INVOICES).collect()}
    decided = {name.removeprefix("batch "): row.decision for name, row in found.items()}
    assert decided.pop("") == "undecided"  # the two amounts of the day that no batch of its own decides
    assert decided == {"plain1": "major", "plain2": "major", "plain3": "major", "negative": "major", "truly whole": "major",
                       "whole cents": "minor", "text cents": "minor", "text major": "major", "no amounts": "undecided",
                       "far off": "undecided"}
    assert 30 < found["batch whole cents"].factor < 300 and found["batch truly whole"].all_whole


def test_recovered_amounts(spark):
    rows = {r.invoice_id: r.amount for r in strict.stage_recovered(raw_invoices(spark), INVOICES).collect()}
    for batch, _, expected in batches():
        for n, amount in enumerate(expected):
            got = rows[f"{batch}-{n}"]
            assert (got is None) == (amount is None) and (amount is None or abs(float(got) - amount) < 0.006), (batch, n)


def test_small_batches_of_a_day_are_decided_together(spark):
    rnd = random.Random(2)
    rows = [(T0, 1, f"a{n}", {"invoice_id": f"a{n}", "amount": rnd.randrange(10000, 90000) / 100 + 0.001}) for n in range(30)]
    rows += [(T0 + timedelta(days=d), 1, f"b{d}{n}", {"invoice_id": f"b{d}{n}", "amount": 1 + n + 0.5}) for d in (2, 3) for n in range(20)]
    rows += [(T0 + timedelta(days=1), 1, f"c{n}", {"invoice_id": f"c{n}", "amount": rnd.randrange(1000, 9000)}) for n in range(12)]
    found = {(r["_day"], r["_unit"]): r.decision for r in units.unit_decisions(
        strict.parsed_once(envelopes(spark, "invoices", rows), INVOICES), INVOICES).collect()}
    assert len(found) == 4 and {unit for _, unit in found} == {""}
    assert found[(T0 + timedelta(days=1)).date(), ""] == "minor"


def test_malformed_payloads_make_no_row_in_strict_staging(spark):
    raw = envelopes(spark, "drawdowns", [(T0, 1, "b", "oops"), (T0.replace(day=12), 1, "b", '{"drawdown_id":"D4"'),
                                         (T0, 1, "b", {"drawdownId": "D1", "amount": 3.5, "status": " ", "facility_id": ""})])
    rows = strict.stage_recovered(raw, ENTITIES["drawdowns"]).collect()
    assert [(r.drawdown_id, float(r.amount), r.facility_id) for r in rows] == [("D1", 3.5, None)]


def test_an_empty_entity_and_an_inverted_rate(spark):
    assert strict.stage_recovered(envelopes(spark, "invoices", []), INVOICES).count() == 0
    rates = [1.1, 1.11, 1.12, 1.1, 1 / 1.1]
    raw = envelopes(spark, "fx_transactions", [
        (T0, 1, "b", {"transaction_id": f"T{n}", "base_currency": "EUR", "quote_currency": "USD", "rate": r}) for n, r in enumerate(rates)])
    found = {r.transaction_id: r.rate for r in strict.stage_recovered(raw, ENTITIES["fx_transactions"]).collect()}
    assert abs(found["T4"] - 1.1) < 1e-9 and found["T0"] == 1.1


def test_strict_staging_scans_the_raw_events_once(spark):
    scans = []

    def raw(name):
        scans.append(name)
        return envelopes(spark, name, [(T0, 1, "b", {ENTITIES[name].key: "K1", "customerId": "C1", "status": "Approved",
                                                     "facility_id": "F1", "amount": 5})])

    house = Warehouse(spark, raw, now=F.lit(T0).cast("timestamp_ntz"), strict=True)
    house.dim_customers()
    facts = house.fct_drawdowns().collect()
    assert sorted(scans) == sorted(set(scans))
    assert [r.customer_id for r in facts] == ["C1"] and not facts[0].is_orphaned
    plan = house.staged("drawdowns")._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan
