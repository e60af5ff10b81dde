"""Exact, line and SimHash deduplication, against brute force."""

import hashlib
import os
import re
import sys

import numpy as np
import pytest
import xxhash

sys.path.insert(0, os.path.dirname(__file__))
from helpers import awkward_rows, clashing, collected, docs  # noqa: E402

from corpus_pipeline import STAGES  # noqa: E402
from loomledger.llm.exact_dedup import exact_duplicates, tree_merge  # noqa: E402
from loomledger.llm.line_dedup import delete_repeated_lines  # noqa: E402
from loomledger.llm.queries import ORACLE_SQL, QUERIES  # noqa: E402
from loomledger.llm.simhash import embed, fingerprint, keep_one_each, links_of_cells, simhash_components  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")
key = lambda row: tuple((x is None, x) if not isinstance(x, bool) else (False, int(x)) for x in row)


def exact_brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r[1] or ""), []).append((r[0], len(r[1] or "")))
    out = []
    for plain, members in groups.items():
        best = min(members, key=lambda m: (-m[1], m[0] is None, m[0] or 0))
        out += [(m[0], best[0], len(members), m[0] == best[0] and m[1] == best[1], hashlib.sha256(plain.encode()).hexdigest())
                for m in members]
    return out


@pytest.mark.parametrize("partitions", [1, 7])
def test_exact_duplicates_equal_brute_force(spark, partitions):
    got = exact_duplicates(clashing(docs(spark).repartition(partitions), ["digest", "kept", "chars", "size"]))
    assert sorted(collected(got), key=key) == sorted(exact_brute(awkward_rows()), key=key)


def test_exact_duplicates_of_an_empty_table(spark):
    assert exact_duplicates(docs(spark, [])).collect() == []


def test_exact_duplicates_equal_sql(spark, duck, sf_dir):
    got = QUERIES["op4_exact_dedup"](spark, sf_dir).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert sorted(collected(got)) == sorted(duck.execute(ORACLE_SQL["op4_exact_dedup"]).fetchall())


def test_runs_are_reduced_before_every_exchange(spark):
    rows = spark.createDataFrame([(1, 1, b"x", 1, 5)], "doc_id long, chars long, digest binary, n_bytes int, check long")
    plan = tree_merge(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_max") >= 2 and plan.count("Exchange hashpartitioning(place") == 2


def shingle_hash(words):
    """The operator's hash of some words, by whole numbers."""
    def mixed(v):
        v = (v ^ v >> 30) * 0xBF58476D1CE4E5B9 % 2**64
        v = (v ^ v >> 27) * 0x94D049BB133111EB % 2**64
        return v ^ v >> 31

    hashes = [mixed(sum((c + 1) * pow(0x9E3779B97F4A7C15, i, 2**64) for i, c in enumerate(w.encode())) % 2**64) for w in words]
    return mixed(sum(h * pow(0xD1342543DE82EF95, i, 2**64) for i, h in enumerate(hashes)) % 2**64)


def lines_brute(rows, size=10, window=19):
    """Winnowing by plain loops and words compared as text: (id, text) to the text that is left."""
    known, parsed = {}, []
    for r in sorted({(r[0], r[1]) for r in rows}, key=lambda r: (r[0] is not None, r[0] or 0)):
        words = [(n, w) for n, line in enumerate((r[1] or "").split("\n")) for w in WORD.findall(line)]
        plain = [w for _, w in words]
        shingles = [tuple(plain[i:i + size]) for i in range(len(plain) - size + 1)]
        for s in shingles:
            if s not in known:
                known[s] = shingle_hash(s)
        chosen = {i for i in range(len(shingles)) if i == 0 or words[i][0] != words[i - 1][0]}
        chosen |= {min(range(i, i + window), key=lambda j: (known[shingles[j]] >> 32, -j)) for i in range(len(shingles) - window + 1)}
        parsed.append((r, words, plain, shingles, sorted(chosen)))
    first = {}
    for d, (_, _, _, shingles, chosen) in enumerate(parsed):
        for i in chosen:
            first.setdefault(shingles[i], (d, i))
    out = {}
    for d, (r, words, plain, shingles, chosen) in enumerate(parsed):
        gone = set()
        for i in chosen:
            e, o = first[shingles[i]]
            room = i - o - size if e == d else window - 1
            if room < 0:
                continue
            other, left, right = parsed[e][2], 0, 0
            while left < min(room, window - 1, i, o) and plain[i - left - 1] == other[o - left - 1]:
                left += 1
            while right < min(room, window - 1) and i + size + right < len(plain) and o + size + right < len(other) \
                    and plain[i + size + right] == other[o + size + right]:
                right += 1
            gone |= set(range(i - left, i + size + right))
        kept = []
        for n, line in enumerate((r[1] or "").split("\n")):
            own = [i for i, w in enumerate(words) if w[0] == n]
            if gone.isdisjoint(own):
                kept.append(line)
            elif not gone.issuperset(own):
                at = iter(own)
                rest = re.sub(r"([^\x20\x09-\x0D]+)[ \t\x0b\x0c\r]*", lambda m: "" if next(at) in gone else m[0], line)  # noqa: B023
                kept.append(rest.rstrip(" \t\x0b\x0c\r") if own[-1] in gone else rest)
        out[r] = None if r[1] is None else "\n".join(kept)
    return out


@pytest.mark.parametrize("partitions", [1, 5])
def test_line_dedup_equals_brute_force(spark, partitions):
    """All awkward rows; lines of every length; a shared passage broken and placed in many ways."""
    rnd = np.random.default_rng(3)
    word = lambda: "".join(chr(97 + c) for c in rnd.integers(0, 26, 5))
    shared = "alpha beta gamma delta\nepsilon zeta eta theta iota\nkappa lambda mu nu"
    passage = [word() for _ in range(70)]
    rows = awkward_rows()
    rows += [(400, f"one line here\n{shared}\nend", "en", "s", 1), (401, f"other\n{shared}\n\nkappa lambda", "en", "s", 1),
             (402, "\n".join(["same line again and again it comes back once more"] * 5), "en", "s", 1),
             (403, " ".join(["word"] * 3000), "en", "s", 1), (404, " ".join(["a", "b"] * 200) + " \n  c", "en", "s", 1)]
    for i in range(40):
        a, b = sorted(rnd.integers(0, 71, 2).tolist())
        parts = [word() for _ in range(rnd.integers(0, 30))] + passage[a:b] + [word() for _ in range(rnd.integers(0, 30))]
        rows.append((410 + i, "".join(w + ["  ", "\n", " \n\n ", *[" "] * 12][rnd.integers(0, 15)] for w in parts), "en", "s", 1))
    expected = lines_brute(rows)
    table = clashing(docs(spark, rows), ["spans", "n_lines", "doc_hash", "_matches", "_doc_id"]).repartition(partitions)
    got = delete_repeated_lines(table).select("doc_id", "text", "n_lines", "deleted_lines").collect()
    assert sorted(((r[0], r[1]) for r in got), key=key) == sorted(((r[0], expected[r[0], r[1]]) for r in rows), key=key)
    lines = {(r[0], expected[r[0], r[1]]): (r[1].count("\n") + 1 if r[1] is not None else 0) for r in rows}
    assert all(r.n_lines == lines[r[0], r[1]] and r.deleted_lines <= r.n_lines for r in got)
    by_id = {r.doc_id: r for r in got}
    assert by_id[401].text == "other\n\nkappa lambda" and by_id[401].deleted_lines == 3
    assert by_id[402].text == "same line again and again it comes back once more" and by_id[402].deleted_lines == 4
    # The line's start and then the last shingle of the first window are its first fingerprints.
    assert by_id[403].text == " ".join(["word"] * 18)


@pytest.mark.parametrize("kind", ["a line inside a longer one", "two lines of thirty", "inside two long lines"])
def test_line_dedup_finds_runs_of_28_words_wherever_they_stand(spark, kind):
    rnd = np.random.default_rng(28)
    words = lambda n: ["".join(chr(97 + c) for c in rnd.integers(0, 26, 6)) for _ in range(n)]
    rows, expected = [], {}
    for i in range(200):
        run = words(28 if kind == "two lines of thirty" else 30)
        if kind == "a line inside a longer one":
            first, around = run, (words(20), words(25))
        elif kind == "two lines of thirty":
            first, around = [*words(2), *run], ([], words(2))
        else:
            first, around = [*words(40), *run, *words(15)], (words(12), words(60))
        rows += [(i, " ".join(first), "en", "s", 1), (1000 + i, " ".join([*around[0], *run, *around[1]]), "en", "s", 1)]
        expected |= {i: rows[-2][1], 1000 + i: " ".join([*around[0], *around[1]])}
    assert {r.doc_id: r.text for r in delete_repeated_lines(docs(spark, rows)).collect()} == expected


def test_line_dedup_leaves_clean_prose(spark):
    """Texts over a few hundred words that share no ten words in a row."""
    rnd = np.random.default_rng(9)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = [(i, "\n".join(" ".join(rnd.choice(vocabulary, rnd.integers(1, 90))) for _ in range(8)), "en", "s", 1) for i in range(200)]
    assert {r.doc_id: r.text for r in delete_repeated_lines(docs(spark, rows)).collect()} == {r[0]: r[1] for r in rows}


def test_line_dedup_shuffles_texts_once(spark):
    """The texts' shuffle serves both joins; lists of matches need none beside their grouping."""
    rows = [(i, f"text {i} " + " ".join(f"word{j}" for j in range(40)), "en", "s", 1) for i in range(4)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = delete_repeated_lines(docs(spark, rows).repartition(3))
        assert len(got.collect()) == 4
        plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("ReusedExchange") == 1 and plan.count("Exchange hashpartitioning(_doc_id") == 2
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Exchange hashpartitioning(_list_id" not in plan


@pytest.mark.parametrize("size", [60, 48])
def test_line_dedup_finds_a_passage_inside_two_different_lines(spark, size):
    rnd = np.random.default_rng(size)
    word = lambda: "".join(chr(97 + c) for c in rnd.integers(0, 26, 6))
    passage = [word() for _ in range(size)]
    around = [[word() for _ in range(n)] for n in (70, 90, 40, 25)]
    first, second = around[0] + passage + around[1], around[2] + passage + around[3]
    rows = [(1, " ".join(first), "en", "s", 1), (2, "a short line\n" + " ".join(second) + "\nits end", "en", "s", 1)]
    got = {r.doc_id: r for r in delete_repeated_lines(docs(spark, rows)).collect()}
    assert got[1].text == rows[0][1] and got[2].n_lines == 3 and got[2].deleted_lines == 0
    lines = got[2].text.split("\n")
    left = lines[1].split()
    assert (lines[0], lines[2]) == ("a short line", "its end")
    gone = [w for w in second if w not in left]
    assert 10 <= len(gone) and set(gone) <= set(passage) and left == [w for w in second if w in left]


def test_line_dedup_of_an_empty_table(spark):
    assert delete_repeated_lines(docs(spark, [])).collect() == []


def simhash_brute(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_brute(rows):
    prints = [simhash_brute(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 4:
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return [(r[0], p, least.get(find(i))) for i, (r, p) in enumerate(zip(rows, prints, strict=True))]


def test_simhash_components_equal_brute_force(spark):
    rows = awkward_rows()
    got = simhash_components(clashing(docs(spark, rows), ["fp", "component_id"]))
    assert sorted(((a, b % 2**64, c) for a, b, c in collected(got)), key=key) == sorted(components_brute(rows), key=key)


def test_one_row_of_each_component_stays(spark):
    rows = awkward_rows()
    kept = sorted(r.doc_id for r in keep_one_each(clashing(docs(spark, rows), ["fp", "_place", "component"])).collect())
    assert kept == sorted({c for _, _, c in components_brute(rows) if c is not None})


def test_the_pipeline_keeps_clean_documents_without_an_id_or_under_one_id(spark):
    texts = [f"clean text number {i} about {' '.join(hashlib.sha256(str(i).encode()).hexdigest())}" for i in range(6)]
    rows = [(None, texts[0], "en", "s", 1), (None, texts[1], "en", "s", 1), (None, texts[1], "en", "s", 1), (5, texts[2], "en", "s", 1),
            (5, texts[3], "en", "s", 1), (7, texts[4], "en", "s", 1), (6, texts[4], "en", "s", 1), (None, texts[4], "en", "s", 1), (8, texts[5], "en", "s", 1)]
    assert len({c for *_, c in components_brute([(i, *r[1:]) for i, r in enumerate(rows)])}) == 6
    stage = dict(STAGES)["SimHash near-dedup"]
    kept = sorted(((r.doc_id, r.text) for r in stage(spark, docs(spark, rows), "").collect()), key=key)
    assert kept == sorted([(None, texts[0]), (None, texts[1]), (5, texts[2]), (5, texts[3]), (6, texts[4]), (8, texts[5])], key=key)


def test_simhash_of_an_empty_table(spark):
    assert simhash_components(docs(spark, [])).collect() == []
    assert keep_one_each(docs(spark, [])).collect() == []


def test_manhattan_distance_bounds_the_bits():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 2**63, (2, 2000)).astype(np.uint64)
    assert (np.bitwise_count(embed(a) ^ embed(b)) <= np.bitwise_count(a ^ b)).all()


@pytest.mark.parametrize("size", [2, 20, 400])
def test_links_of_a_cell_connect_all_near_points(size):
    rng = np.random.default_rng(size)
    base = np.uint64(0x123456789ABCDEF0)
    fp = np.unique(base ^ (np.uint64(1) << rng.integers(0, 64, size).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, size).astype(np.uint64)))
    a, b = links_of_cells(np.zeros(len(fp), dtype=np.int64), fp, 2)
    root = list(range(len(fp)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in zip(a.tolist(), b.tolist(), strict=True):
        root[find(i)] = find(j)
    for i in range(len(fp)):
        for j in range(i):
            if bin(int(fp[i] ^ fp[j])).count("1") <= 2:
                assert find(i) == find(j)
    assert fingerprint("") == 0
