"""Staging states: any split of the events, touched buckets only, failed runs."""

import itertools
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from support import T0, envelopes

from loomledger.plans.entities import ENTITIES
from loomledger.plans.incremental import StagingState
from loomledger.plans.staging import stage
from loomledger.sources.envelope import write_raw_events
from loomledger.sources.versions import Buckets

ENTITY = ENTITIES["drawdowns"]


def payloads(seed=5, count=120):
    """Repeated keys over days, back-dated batches, ties, keys missing, malformed and empty payloads."""
    rnd = random.Random(seed)
    rows = [(T0 + timedelta(days=rnd.randrange(6)), rnd.randrange(2), f"b{rnd.randrange(4)}",
             {"drawdown_id": rnd.choice([None, *[f"D{n}" for n in range(25)]]), "amount": rnd.randrange(100)}) for _ in range(count)]
    rows += [(T0, 1, None, {"drawdown_id": "D1", "amount": 1}), (T0, 1, "b", "oops"), (T0, 1, "b", ""), (T0, 1, "b", None),
             (T0, 1, "b", '{"drawdown_id":"D2"'), rows[0], rows[1]]
    return rows


def rows_of(df):
    return sorted(str(tuple(row)) for row in df.collect())


@pytest.mark.parametrize("seed", range(3))
def test_any_split_equals_a_full_rescan(spark, tmp_path, seed):
    rows, rnd = payloads(seed), random.Random(seed)
    state = StagingState(spark, str(tmp_path / "state"), ENTITY, n_buckets=5)
    assert state.read().count() == 0
    parts = [[] for _ in range(4)]
    for row in rows:
        rnd.choice(parts).append(row)
    for part in [*parts, parts[1]]:
        state.merge(envelopes(spark, "drawdowns", part))
    expected = rows_of(stage(envelopes(spark, "drawdowns", rows), ENTITY))
    assert rows_of(state.read()) == expected
    assert rows_of(StagingState(spark, str(tmp_path / "state"), ENTITY).read()) == expected


def test_only_touched_buckets_are_read_and_replaced(spark, tmp_path):
    state = StagingState(spark, str(tmp_path / "state"), ENTITY, n_buckets=8)
    state.merge(envelopes(spark, "drawdowns", payloads()))
    before = dict(state.buckets.versions)
    late = envelopes(spark, "drawdowns", [(T0.replace(year=2020), 1, "late", {"drawdown_id": "D3", "amount": 9}),
                                          (T0, 1, "late", {"drawdown_id": "new", "amount": 9})])
    touched = state.merge(late)
    assert len(touched) <= 2
    assert {b for b, v in state.buckets.versions.items() if before.get(b) != v} == set(touched)
    held = state.buckets.read(state.schema, touched).inputFiles()
    assert {f.split("_bucket=")[1].split("/")[0] for f in held} == {str(b) for b in touched}
    fresh = state.buckets.read(state.schema, touched).withColumn("_bucket", F.lit(0))
    plan = state.merged(fresh, touched)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_a_failed_run_leaves_the_state_as_it_was(spark, tmp_path):
    state = StagingState(spark, str(tmp_path / "state"), ENTITY, n_buckets=3)
    state.merge(envelopes(spark, "drawdowns", payloads()))
    before = rows_of(state.read())
    held = state.buckets.read(state.schema).withColumn("_bucket", F.when(
        F.monotonically_increasing_id() >= 0, F.raise_error(F.lit("stopped"))).cast("int"))
    with pytest.raises(Exception, match="stopped"):
        state.buckets.replace(held, [0, 1, 2])
    assert rows_of(StagingState(spark, str(tmp_path / "state"), ENTITY).read()) == before


def test_two_writers_cannot_both_publish(spark, tmp_path):
    rows = spark.range(4).withColumn("_bucket", F.lit(1))
    one, other = (Buckets(spark, str(tmp_path / "table"), 4) for _ in range(2))
    one.replace(rows, [1])
    with pytest.raises(RuntimeError):
        other.replace(rows.limit(1), [1])
    assert Buckets(spark, str(tmp_path / "table")).read("id long").count() == 4


def test_following_the_landing_takes_files_of_old_days(spark, tmp_path):
    landing, state = str(tmp_path / "landing"), StagingState(spark, str(tmp_path / "state"), ENTITY, n_buckets=4)
    rows = payloads(9)
    for number, part in enumerate(itertools.batched(rows, 50)):
        events = envelopes(spark, "drawdowns", part).withColumn("_batch_id", F.concat(F.lit(f"r{number}-"), "_batch_id"))
        write_raw_events(events, landing, ENTITY)
        state.follow(landing, files_at_once=2)
    raw = spark.read.parquet(f"{landing}/raw_events").drop("year", "month", "day")
    assert rows_of(state.read()) == rows_of(stage(raw, ENTITY))
