"""Landing without a shuffle of JSON, marts written alone, memory of packing's workers."""

import re
import tracemalloc

from loomledger.llm.tokenizers_io import vocabulary_path
from loomledger.llm.word_ids import WordEncoder
from loomledger.plans.colocated import BucketedStar
from loomledger.plans.entities import ENTITIES
from loomledger.sources import envelope, tables
from loomledger.testbed import landing as ld


def exchanged(df) -> list[str]:
    """The output columns of every exchange in a plan."""
    plan = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", plan)


def test_landing_shuffles_narrow_rows_once(spark, sf_dir):
    for name in ENTITIES:
        moved = exchanged(ld.packed_events(spark, sf_dir, name, by_day=True))
        assert len(moved) == 1, name
        assert not re.search(r"\b(data|_batch_id|_source)#", moved[0]), name


def test_dealt_rows_are_the_same_events(spark, sf_dir):
    for name in ENTITIES:
        dealt = ld.packed_events(spark, sf_dir, name, by_day=True)
        plain = ld.packed_events(spark, sf_dir, name)
        assert dealt.columns == plain.columns + envelope.DAY_COLUMNS
        dealt = dealt.select(*plain.columns)
        assert dealt.exceptAll(plain).isEmpty() and plain.exceptAll(dealt).isEmpty(), name


def test_dealt_events_are_landed_once_beside_other_entities(spark, sf_dir, tmp_path):
    entity = ENTITIES["invoices"]
    envelope.write_raw_events(ld.packed_events(spark, sf_dir, "company_metrics", by_day=True), str(tmp_path), ENTITIES["company_metrics"])
    events = ld.packed_events(spark, sf_dir, "invoices")
    for _ in range(2):
        envelope.write_raw_events(ld.packed_events(spark, sf_dir, "invoices", by_day=True), str(tmp_path), entity)
    held = envelope.read_raw_events(spark, str(tmp_path), entity)
    assert held.exceptAll(events).isEmpty() and events.exceptAll(held).isEmpty()


def test_only_the_models_that_a_job_reads_are_written(spark, sf_dir, tmp_path):
    whole = ld.warehouse(spark, sf_dir)
    built = tables.build(whole, str(tmp_path), models=["fct_fx_transactions"])
    assert [str(path.relative_to(tmp_path)) for path in tmp_path.glob("*/*")] == ["marts/fct_fx_transactions"]
    held, expected = built.fct_fx_transactions(), whole.fct_fx_transactions()
    assert held.exceptAll(expected).isEmpty() and expected.exceptAll(held).isEmpty()
    assert tables.build(built, str(tmp_path / "more"), models=["dim_customers"]).tables.keys() == {"fct_fx_transactions", "dim_customers"}


def test_buckets_of_parents_wait_for_a_fact_that_needs_them(spark, sf_dir, tmp_path):
    staged = ENTITIES["fx_transactions"].table
    star = BucketedStar(tables.build(ld.warehouse(spark, sf_dir), str(tmp_path / "built"), models=[staged]), str(tmp_path / "star"), 4)
    assert star.fct_fx_transactions().count() == ld.warehouse(spark, sf_dir).fct_fx_transactions().count()
    assert not any(path.name.startswith("facilities") for path in (tmp_path / "star").iterdir())


def test_encoding_holds_little_beside_the_ids():
    encoder = WordEncoder(vocabulary_path("word_bpe_49k.json", None))
    texts = [f"alpha beta gamma{n % 7} x-ray " * 250 for n in range(400)]
    assert sum(map(len, texts)) > 2_000_000
    encoder.encode(texts[:7])
    tracemalloc.start()
    encoder.encode(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 32_000_000
