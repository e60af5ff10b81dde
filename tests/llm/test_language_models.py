"""Mixing, neighbours, language models, quality, language and the pipeline."""

import collections
import math
import os
import re
import sys
from zlib import crc32

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
from helpers import awkward_rows, clashing, docs  # noqa: E402

import corpus_pipeline  # noqa: E402
from loomledger.llm.ann import encode, nearest  # noqa: E402
from loomledger.llm.common import table  # noqa: E402
from loomledger.llm.langid import document_rows, identify, keep_identified, page_rows  # noqa: E402
from loomledger.llm.mixing import Recipe, allocate, fill_targets, mixed_rows, split_quotas  # noqa: E402
from loomledger.llm.quality import quality, quantiles, train, word_keys  # noqa: E402
from loomledger.llm.suffix_tree import SuffixAutomaton, kept_contexts, score_documents, string_counts  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# Mixing

def test_targets_fill_up_to_their_caps():
    # By hand: 315 words; the second source stops at 20, of the other 295 three fifths and two fifths.
    assert fill_targets([100, 10, 100], Recipe()) == pytest.approx([177, 20, 118])
    # 4.5 words; the first stops at 2, of the other 2.5 one third and two thirds.
    assert fill_targets([1, 1, 1], Recipe()) == pytest.approx([2, 2.5 / 3, 5 / 3])
    # Weights 3, 1, 2, 3: 600 words over sizes of 100 would be 200, 66.7, 133.3, 200; none is above 200.
    assert fill_targets([100] * 4, Recipe()) == pytest.approx([200, 200 / 3, 400 / 3, 200])
    assert fill_targets([], Recipe()) == [] and fill_targets([0, 5], Recipe()) == pytest.approx([0, 7.5])


def test_splitting_tree_is_exact_and_repeatable():
    leaves = split_quotas([50, 0, 7, 300], 8, 3)
    assert leaves.sum(axis=0).tolist() == [50, 0, 7, 300] and (leaves >= 0).all()
    assert abs(leaves.sum(axis=1) - 357 / 8).max() <= 3
    assert (split_quotas([50, 0, 7, 300], 8, 3) == leaves).all()


def test_mix_meets_targets(spark):
    rows = awkward_rows()
    taken = allocate(clashing(docs(spark, rows), ["mix_size", "copy", "shard", "_block", "words"])).collect()
    assert len(taken) == len(rows)
    sizes = collections.Counter()
    for r in rows:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    names = sorted((s for s in sizes if s is not None)) + [None]
    targets = dict(zip(names, fill_targets([sizes[s] for s in names], Recipe()), strict=True))
    sums = collections.Counter()
    for r in taken:
        assert r.mix_size == len(WORD.findall(r.text or "")) and r.mix_source_size == sizes[r.source]
        assert r.mix_target == pytest.approx(targets[r.source]) and 0 <= r.mix_taken <= 2 * r.mix_size
        assert r.mix_taken == sum(d.words for d in r.mix_draws)
        sums[r.source] += r.mix_taken
    repeated = max(len(WORD.findall(r[1] or "")) for r in rows if rows.count(r) > 1)
    assert all(abs(sums[s] - targets[s]) <= 1 + 2 * repeated for s in names)
    again = allocate(docs(spark, rows).repartition(5)).collect()
    as_rows = lambda got: sorted(((r.doc_id or -1, r.mix_size, r.mix_taken) for r in got))
    assert as_rows(again) == as_rows(taken)
    mixed = mixed_rows(docs(spark, rows)).collect()
    assert sum(len(WORD.findall(r.text or "")) for r in mixed) == sum(sums.values())
    assert len({r.shard for r in mixed}) > 8


def test_blocks_without_a_draw_stay_out_of_the_mix(spark):
    """Sources a and b are both to give fewer words than they have."""
    rows = [(i, "one two three four five six seven eight nine ten", "en", "ab"[i % 2], 1) for i in range(600)]
    recipe = Recipe(weights=(1, 3), share=0.5)
    targets = dict(zip("ab", fill_targets([3000, 3000], recipe), strict=True))
    assert targets == {"a": 750, "b": 2250}
    taken = allocate(docs(spark, rows), recipe).collect()
    mixed = mixed_rows(docs(spark, rows), recipe).collect()
    for source, target in targets.items():
        assert sum(r.mix_taken for r in taken if r.source == source) == target
        assert sum(d.words for r in taken if r.source == source for d in r.mix_draws) == target
        assert sum(len(WORD.findall(r.text)) for r in mixed if r.source == source) == target
    assert all(0 <= r.shard < recipe.shards and r["copy"] >= 0 for r in mixed)


def test_mixed_rows_are_shuffled_within_their_shards(spark, monkeypatch):
    rows = [(i if i % 3 else None, f"w{i} " * 10, "abc"[i * 3 // 900], "s", 1) for i in range(900)]
    mixed_in = lambda df: df.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()).collect()
    one = mixed_in(mixed_rows(docs(spark, rows), Recipe(shards=4)))
    monkeypatch.setattr("loomledger.llm.mixing.PIECE_WORDS", 700)
    split = mixed_in(mixed_rows(docs(spark, rows), Recipe(shards=4)))
    for got in (one, split):
        shards = collections.defaultdict(set)
        for r in got:
            shards[r.part].add(r.shard)
        assert all(len(found) == 1 for found in shards.values())
        in_order = [(r.shard, r.shuffle_key) for r in sorted(got, key=lambda r: r.at)]
        assert in_order == sorted(in_order) and {shard for shard, _ in in_order} == set(range(4))
    assert len({r.part for r in one}) == 4 < len({r.part for r in split})
    assert sorted(r.text for r in one) == sorted(r.text for r in split)


def test_mix_of_an_empty_table(spark):
    assert allocate(docs(spark, [])).collect() == [] and mixed_rows(docs(spark, [])).collect() == []


# Nearest neighbours

def brute_neighbours(rows, queries, k):
    good = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, a in good:
        if q in queries:
            scored = [(-round(float(a @ b / np.linalg.norm(a) / np.linalg.norm(b)), 12), i) for i, b in good if i != q and len(b) == len(a)]
            out[q] = [i for _, i in sorted(scored)[:k]]
    return out


def test_neighbours_equal_brute_force_with_awkward_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.standard_normal(24).tolist()) for i in range(400)]
    rows += [(400 + i, rows[0][1]) for i in range(8)]
    rows += [(500, None), (501, []), (502, [0.0] * 24), (503, [float("nan")] + [1.0] * 23), (504, [None] + [1.0] * 23),
             (505, [float("inf")] * 24), (506, [1.0, 2.0]), (507, [2.0, 1.0]), (None, [1.0] * 24)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    rows32 = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    asked = {i for i, _ in rows if i is not None and i % 20 == 0} | {506}
    found = nearest(clashing(df, ["rank", "score", "code"]), df.filter(F.col("vec_id").isin(*asked)), 5).collect()
    got = collections.defaultdict(dict)
    for r in found:
        got[r.query_id][r["rank"]] = r.vec_id
    expected = brute_neighbours(rows32, asked, 5)
    assert {q: [v[i + 1] for i in range(len(v))] for q, v in got.items()} == expected


def test_recall_on_the_given_vectors(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    asked = {i for i, _ in rows if i % 50 == 0}
    expected = brute_neighbours(rows, asked, 5)
    found = nearest(vectors, vectors.filter("vec_id % 50 = 0"), 5).collect()
    hits = sum(r.vec_id in expected[r.query_id] for r in found)
    assert hits >= 0.9 * sum(map(len, expected.values()))


def test_no_vectors_no_neighbours(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert nearest(df, df, 5).collect() == []
    bits, scalar = encode(np.eye(9))
    assert bits.shape == (9, 2) and (scalar <= 1).all()


# Language-model scores

def base_brute(rows):
    texts = [WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[1] or "")) + [None] for r in rows]
    held = [crc32(("" if r[0] is None else str(r[0])).encode()) % 7 == 2 for r in rows]
    counts = collections.Counter(w for t, h in zip(texts, held, strict=True) if not h for w in t)
    n, v = sum(counts.values()), len(counts)
    return sorted((r[0] is None, r[0] or 0, h, len(t), sum(counts[w] > 0 for w in t), n,
                   round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t), 6)) for r, t, h in zip(rows, texts, held, strict=True))


def test_word_baseline_equals_brute_force(spark):
    rows = awkward_rows()
    got = score_documents(clashing(docs(spark, rows), ["score", "held_out", "batch"])).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == base_brute(rows)
    assert all(r.score < 0 for r in got)


def test_tree_beats_the_baseline_on_held_out_texts(spark):
    held = [r for r in score_documents(table(spark, "/root/testdata/sf0.1", "documents")).collect() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_scores_of_an_empty_table(spark):
    assert score_documents(docs(spark, [])).collect() == []


def test_automaton_is_a_distribution_and_takes_the_longest_context(spark):
    rows = spark.createDataFrame([("ab abc abd " * 50,), ("bca " * 60,)], "text string").selectExpr("1L AS doc_id", "false AS held_out", "text")
    kept = kept_contexts(string_counts(rows).cache(), 1e-4, 1000)
    automaton = SuffixAutomaton.build(kept)
    seen = len(kept[0])
    mass = 10.0 ** automaton.scores.astype(float)
    total = mass[:, :-1].sum(axis=1) + mass[:, -1] * (256 - seen)
    assert np.allclose(total, 1, atol=1e-4)
    contexts = {(depth, c) for depth, frame in enumerate(kept) for c in frame["context"]}
    order = {}
    for depth in range(len(kept)):
        for c in sorted(x for d, x in contexts if d == depth):
            order[depth, c] = len(order)
    text = b"ab abc abd bca bca ab"
    state = 0
    for i, byte in enumerate(text):
        state = automaton.goes[state, automaton.classes[byte]]
        past = text[:i + 1]
        longest = max(d for d in range(min(len(kept) - 1, len(past)) + 1) if (d, int.from_bytes(past[len(past) - d:], "big")) in order)
        assert automaton.table[state] == order[longest, int.from_bytes(past[len(past) - longest:], "big")]


# Quality

def test_kneser_ney_is_a_distribution(spark):
    rows = docs(spark).filter("doc_id < 20")
    model = train(rows)
    words = sorted({w for r in rows.collect() for w in r.text.lower().split()})
    for context in (["the", "of"], ["never", "seen"], [words[0], words[1]]):
        texts = [" ".join([*context, w]) for w in words]
        total = 0.0
        for text in texts:
            keys, _ = word_keys([text])
            total += math.exp(model.log_probabilities(keys, np.array([4]))[0])
        keys, _ = word_keys([" ".join(context)])
        total += math.exp(model.log_probabilities(keys, np.array([4]))[0])  # the end mark
        assert total + model.unknown == pytest.approx(1, abs=0.02)


def test_quality_separates_the_labelled_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = table(spark, sf, "labels")
    judged = quality(table(spark, sf, "documents"), labels).join(labels, "doc_id").collect()
    good, bad = [r for r in judged if r.quality == 1], [r for r in judged if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.97 * len(good) and sum(not r.kept for r in bad) >= 0.8 * len(bad)


def test_thresholds_are_those_of_all_trusted_rows_outside_the_training(spark):
    sf = "/root/testdata/sf0.01"
    documents = table(spark, sf, "documents").withColumn("lang", F.when(F.col("doc_id") % 5 > 0, F.col("lang")))
    good = table(spark, sf, "labels").filter("quality = 1 AND coalesce(toxic, 0) = 0").select("doc_id").distinct()
    sample = good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(60)
    trained = {r.doc_id for r in sample.filter(F.pmod(F.xxhash64(F.lit(3), F.col("doc_id")), F.lit(3)) != 0).collect()}
    outside = {r.doc_id for r in good.collect()} - trained
    judged = quality(documents, table(spark, sf, "labels"), max_trusted=60).collect()
    for lang in {r.lang for r in judged}:
        held = [r.perplexity for r in judged if r.lang == lang and r.doc_id in outside]
        limits = {r.threshold for r in judged if r.lang == lang}
        if held:
            assert list(limits) == [pytest.approx(1.25 * np.quantile(held, 0.99), rel=1e-9)]
    assert len(outside) > 60


def test_quality_trains_on_two_thirds_of_all_trusted_rows_with_a_model_of_any_size(spark, monkeypatch):
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 30, rng.integers(0, 9))) for _ in range(4000)]
    rows = spark.createDataFrame([(i, t, "en" if i % 3 else None) for i, t in enumerate(texts)] + [(7, "w1 unseen", "en"), (None, None, "en")],
                                 "doc_id long, text string, lang string").repartition(3)
    labels = rows.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    judged = quality(rows, labels).collect()
    back = {r.doc_id for r in labels.filter(F.pmod(F.xxhash64(F.lit(3), F.col("doc_id")), F.lit(3)) == 0).collect()}
    for lang in ("en", None):
        held = [r.perplexity for r in judged if r.lang == lang and r.doc_id is not None and r.doc_id in back]
        assert list({r.threshold for r in judged if r.lang == lang}) == [pytest.approx(1.25 * np.quantile(held, 0.99), rel=1e-9)]
    monkeypatch.setattr("loomledger.llm.quality.HELD_GRAMS", 0)
    by_shards = quality(rows, labels).collect()
    order = lambda r: (r.doc_id is None, r.doc_id, r.n_tokens)
    for a, b in zip(sorted(judged, key=order), sorted(by_shards, key=order), strict=True):
        assert (a.doc_id, a.lang, a.n_tokens) == (b.doc_id, b.lang, b.n_tokens)
        assert b.perplexity == pytest.approx(a.perplexity, rel=1e-9)
        assert b.threshold == pytest.approx(a.threshold, rel=1e-9)


def test_quantiles_equal_those_of_numpy(spark):
    rng = np.random.default_rng(5)
    rows = [("a", float(x)) for x in np.exp(rng.normal(5, 1, 999))] + [("b", 7.5)] * 40 + [("b", 9.0)] * 3 + [("c", 3.0)] + [("d", 1.0), ("d", 2.0)]
    for q in (0.0, 0.5, 0.99, 1.0):
        got = {r.key: r.value for r in quantiles(spark.createDataFrame(rows, "key string, perplexity double"), q).collect()}
        assert got == {k: pytest.approx(np.quantile([x for key, x in rows if key == k], q), rel=1e-12) for k in "abcd"}


def test_quality_takes_awkward_rows(spark):
    rows = awkward_rows()
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)] + [(2, 1, 0), (41, 0, 1), (None, 1, None), (42, None, None)],
                                   "doc_id long, quality int, toxic int")
    assert quality(clashing(docs(spark, rows), ["kept", "threshold", "perplexity"]), labels).count() == len(rows)
    assert quality(docs(spark, []), labels).collect() == []
    assert all(r.kept for r in quality(docs(spark, rows), labels.limit(0)).collect())


# Language

def test_languages_of_documents_and_pages(spark):
    sf = "/root/testdata/sf0.01"
    rows = document_rows(table(spark, sf, "documents")).union(page_rows(table(spark, sf, "pages")))
    got = identify(rows).collect()
    assert len(got) == table(spark, sf, "documents").count() + table(spark, sf, "pages").count()
    assert sum(r.language == r.declared for r in got) >= 0.97 * len(got)


def test_text_overrules_a_wrong_declaration(spark):
    sf = "/root/testdata/sf0.01"
    base = table(spark, sf, "documents")
    swapped = base.withColumn("lang", F.when(F.col("doc_id") % 10 == 0, F.lit("fr")).otherwise(F.col("lang")))
    truth = {r.doc_id: r.lang for r in base.collect()}
    got = [r for r in identify(document_rows(swapped)).collect() if r.id % 10 == 0 and r.trigrams > 300]
    assert sum(r.language == truth[r.id] for r in got) >= 0.85 * len(got)


def test_page_evidence(spark):
    pages = spark.createDataFrame(
        [(1, "HTTP://U@Www.Site.DE:80/x", "<!doctype html><HTML class='a' lang='De-AT'><script>let x='<p>'</script><p>der <b>Hund</b>"),
         (2, None, None), (3, "not an address", "<html><body>text")], "page_id long, url string, html string")
    rows = {r.id: r for r in page_rows(pages).collect()}
    assert (rows[1].declared, rows[1].suffix, rows[1].host) == ("de", "de", "www.site.de")
    assert rows[1].text.split() == ["der", "Hund"] and rows[2].host is None and rows[3].declared is None


def test_language_takes_awkward_rows(spark):
    rows = awkward_rows()
    got = identify(document_rows(docs(spark, rows))).collect()
    assert len(got) == len(rows)
    assert all(r.language == "und" and not r.accepted for r in got if r.id in (200, 201, 202, 203))
    kept = keep_identified(clashing(docs(spark, rows), ["part", "accepted"]))
    assert {200, 201, 202, 203}.isdisjoint({r.doc_id for r in kept.collect()})
    assert keep_identified(docs(spark, [])).collect() == []


# The pipeline

def test_pipeline_stages_keep_the_columns_of_documents(spark, sf_dir, tmp_path):
    documents = table(spark, sf_dir, "documents")
    current = documents
    counts = [documents.count()]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, current, sf_dir).write.parquet(str(tmp_path / str(number)))
        current = spark.read.parquet(str(tmp_path / str(number)))
        counts.append(current.count())
        if number < len(corpus_pipeline.STAGES) - 1:
            assert current.columns == documents.columns
    assert counts[1] >= counts[2] >= counts[3] > 0 and counts[5] >= counts[4]


def test_pipeline_of_awkward_rows(spark, tmp_path):
    docs(spark).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    docs(spark, []).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0


def test_building_the_automaton_takes_little_more_memory_than_its_tables():
    import tracemalloc

    rng = np.random.default_rng(1)
    bytes_ = np.arange(32, 126)
    contexts = np.unique(rng.choice(bytes_, 12_000) << 16 | rng.choice(bytes_, 12_000) << 8 | rng.choice(bytes_, 12_000))
    level = pd.DataFrame({"context": np.repeat(contexts, 3), "symbol": np.tile([40, 60, 90], len(contexts)), "n": 5})
    empty = level.head(0)
    kept = [pd.DataFrame({"context": 0, "symbol": bytes_, "n": 7}), empty, empty, level, empty, empty]
    tracemalloc.start()
    automaton = SuffixAutomaton.build(kept)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(automaton.scores) == 1 + len(contexts)
    assert peak < 2.5 * 8 * automaton.scores.size
    counted = np.full(len(bytes_) + 1, 0.0)
    counted[automaton.classes[[40, 60, 90]]] = 5
    expected = (counted + 9 * 10 ** automaton.scores[0]) / (15 + 9)
    assert np.allclose(10 ** automaton.scores[5][:-1], expected[:-1], rtol=1e-5)
