"""Findings of the third round, continued: what is shuffled and written on the way to the checks."""

import collections
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from loomledger.generate import entities as g
from loomledger.generate.dirt import generate
from loomledger.llm.suffix_tree import DEPTH, kept_contexts, string_counts
from loomledger.plans.entities import ENTITIES
from loomledger.plans.incremental import StagingState
from loomledger.sources.envelope import DAY_COLUMNS, read_raw_events, write_raw_events
from loomledger.sources.tables import materialise
from loomledger.testbed import landing as ld

PLAN = g.Plan(seed=7)


@pytest.mark.parametrize("name", ["invoices", "drawdowns", "repayments"])
def test_generated_rows_are_dealt_before_their_json_is_made(spark, tmp_path, name):
    master = g.customers(spark.range(40), "id", PLAN)
    dealt, plain = generate(master, name, PLAN, by_day=True), generate(master, name, PLAN)
    # Dealt rows come as they lie under the projection that makes the JSON: no text is shuffled or sorted but the customer's.
    plan = dealt._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() == "Project":
        plan = plan.children().apply(0)
    assert plan.nodeName() == "Sort"
    carried = [plan.output().apply(i).name() for i in range(plan.output().size())]
    assert set(DAY_COLUMNS) <= set(carried) and not {"data", "_batch_id", ENTITIES[name].key, "line_items_json"} & set(carried)
    # The days are those of the finished events, and no row changes.
    assert dealt.filter(F.struct("year", "month", "day") != F.struct(
        F.year("_ingested_at"), F.month("_ingested_at"), F.dayofmonth("_ingested_at"))).count() == 0
    rows = dealt.drop(*DAY_COLUMNS)
    assert rows.count() == plain.count() and rows.exceptAll(plain).count() == 0
    write_raw_events(dealt, str(tmp_path), ENTITIES[name])
    assert read_raw_events(spark, str(tmp_path), ENTITIES[name]).exceptAll(plain).count() == 0


def codecs(folder) -> set[str]:
    files = [pq.ParquetFile(path).metadata for path in folder.rglob("*.parquet")]
    return {found.row_group(0).column(i).compression for found in files for i in range(found.num_columns) if found.num_rows}


def test_landed_and_kept_tables_are_written_small(spark, sf_dir, tmp_path):
    invoices = ENTITIES["invoices"]
    write_raw_events(ld.packed_events(spark, sf_dir, "invoices", by_day=True), str(tmp_path / "raw"), invoices)
    assert codecs(tmp_path / "raw") == {"ZSTD"}
    kept = materialise(spark, read_raw_events(spark, str(tmp_path / "raw"), invoices), str(tmp_path / "kept"))
    assert codecs(tmp_path / "kept") == {"ZSTD"}
    assert kept.exceptAll(ld.packed_events(spark, sf_dir, "invoices")).count() == 0


def test_every_context_that_gains_enough_is_kept(spark):
    letters = random.Random(5)
    text = "".join(letters.choices("abcdefghijklmnop", k=60_000))
    rows = spark.createDataFrame([(1, False, text)], "doc_id long, held_out boolean, text string")
    strings = string_counts(rows).cache()
    kept = kept_contexts(strings, 1e-6)
    found = set(kept[DEPTH]["context"])
    nexts, below = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    padded = text + " "
    for i in range(len(text) - DEPTH + 1):
        nexts[padded[i:i + DEPTH]][padded[i + DEPTH]] += 1
        below[padded[i + 1:i + DEPTH]][padded[i + DEPTH]] += 1
    # One that occurs once is certain of its next letter; it gains where its suffix, elsewhere too, is not.
    gaining = {c for c, n in nexts.items() if sum(n.values()) == 1 and len(below[c[1:]]) > 1}
    certain = {int.from_bytes(c.encode(), "big") for c in gaining}
    assert sum(len(frame["context"].unique()) for frame in kept) > 60_000
    assert len(certain) > 30_000 and certain <= found


def test_merged_state_is_written_small(spark, sf_dir, tmp_path):
    state = StagingState(spark, str(tmp_path), ENTITIES["invoices"], n_buckets=2)
    state.merge(ld.raw_events(spark, sf_dir, "invoices"))
    assert codecs(tmp_path) == {"ZSTD"}
