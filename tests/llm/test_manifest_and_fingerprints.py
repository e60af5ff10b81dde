"""Merkle manifests and document fingerprints against brute force."""

import collections
import os
import random
import sys
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
from helpers import awkward_rows, clashing, collected, docs  # noqa: E402

from loomledger.llm.fingerprints import edit_likeness, edited_text, fingerprints, gram_hashes, likeness, winnow  # noqa: E402
from loomledger.llm.merkle import fold, merkle_manifest, steps  # noqa: E402
from loomledger.llm.queries import ORACLE_SQL, QUERIES  # noqa: E402


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return digest(*[part(v) for v in (row[0], row[3], row[2], row[4], text)])


def tree(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i:i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def siblings(levels, at):
    for level in levels[:-1]:
        start = at // 3 * 3
        yield level[start:at], level[at + 1:start + 3]
        at //= 3


def found_text(row):
    touched = row[1] is not None and row[0] is not None and crc32(str(row[0]).encode()) % 2 == 0
    return row[1].replace("\n", "") if touched else row[1]


def manifest_brute(rows):
    sources = collections.defaultdict(list)
    for row in rows:
        sources[row[3]].append((row[0] is not None, row[0] or 0, leaf(row, row[1]), row))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    held = {name: sorted(sources[name], key=lambda x: x[:3]) for name in names}
    trees = {name: tree([x[2] for x in held[name]]) for name in names}
    top = tree([trees[name][-1][0] for name in names])
    for place, name in enumerate(names):
        for at, (_, _, own, row) in enumerate(held[name]):
            path = [*siblings(trees[name], at), *siblings(top, place)]
            folded = leaf(row, found_text(row))
            for left, right in path:
                folded = digest(*left, folded, *right)
            yield (row[0], own, trees[name][-1][0], top[-1][0], digest(*[d for run in path for side in run for d in side]),
                   folded, folded == top[-1][0])


def found():
    return F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0,
                  F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


ordered = lambda rows: sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))
MANIFEST = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize("block_levels", [1, 2, 8])
def test_manifest_equals_brute_force(spark, block_levels):
    table = clashing(docs(spark).repartition(5), ["tree", "index", "digest", "altered", "path", "root", "rank", "size", "block"])
    got = merkle_manifest(table, found(), block_levels).select(*MANIFEST)
    assert ordered(collected(got)) == ordered(manifest_brute(awkward_rows()))


@pytest.mark.parametrize("rows", [
    [], [(1, "a\nb", "en", "s", 3)], [(2, "a", "en", None, 1), (2, "a", "en", None, 1)],
    [(i, f"t{i}\n", "en", "hot" if i % 3 else f"s{i}", 3) for i in range(70)]], ids=["empty", "one", "twins", "hot"])
def test_manifests_of_small_tables(spark, rows):
    got = merkle_manifest(docs(spark, rows), found(), 1).select(*MANIFEST)
    assert ordered(collected(got)) == ordered(manifest_brute(rows))


def test_proofs_lead_to_the_root_and_to_nothing_else(spark):
    rows = merkle_manifest(docs(spark)).collect()
    assert all(r.verified for r in rows)
    for r in rows[::7]:
        assert fold(r.leaf.encode(), bytes(r.proof)).decode() == r.root
        assert fold(digest("other").encode(), bytes(r.proof)).decode() != r.root
        assert digest("".join((a + b).decode() for a, b in steps(bytes(r.proof)))) == r.proof_sha256


def test_manifest_equals_sql(spark, duck, sf_dir):
    got = QUERIES["op13_merkle_manifest"](spark, sf_dir).select(*MANIFEST)
    assert ordered(collected(got)) == ordered(duck.execute(ORACLE_SQL["op13_merkle_manifest"]).fetchall())


# Fingerprints


def winnow_brute(text, gram, window):
    """Positions of the rightmost smallest hash of every window of grams."""
    codes = np.array([ord(c) for c in text], dtype=np.uint32)
    gram = min(gram, len(text))
    hashes = [int(gram_hashes(codes[i:i + gram], gram)[0]) for i in range(len(text) - gram + 1)] if gram else []
    window = min(window, len(hashes))
    kept = {max(range(i, i + window), key=lambda p: (-hashes[p], p)) for i in range(len(hashes) - window + 1)} if hashes else set()
    return [(hashes[p], p) for p in sorted(kept)]


@pytest.mark.parametrize("gram,window", [(1, 1), (3, 4), (5, 7), (16, 64)])
def test_winnowing_equals_brute_force(gram, window):
    rnd = random.Random(gram)
    for length in [0, 1, 2, 4, 5, 15, 16, 17, 79, 80, 200]:
        for letters in ("a", "ab", "aé😀zß"):
            text = "".join(rnd.choice(letters) for _ in range(length))
            hashes, positions = winnow(text, gram, window)
            assert list(zip(hashes.tolist(), positions.tolist(), strict=True)) == winnow_brute(text, gram, window)


def test_a_shared_passage_always_shares_a_fingerprint_at_its_place():
    rnd = random.Random(4)
    prose = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    for _ in range(200):
        shared, before, after = prose(16 + 64 - 1), prose(rnd.randint(0, 300)), prose(rnd.randint(0, 300))
        one = dict(zip(*[x.tolist() for x in winnow(before + shared + prose(50))], strict=True))
        other = dict(zip(*[x.tolist() for x in winnow(after + shared + prose(50))], strict=True))
        places = {(one[h] - len(before), other[h] - len(after)) for h in one.keys() & other.keys()}
        assert any(a == b and 0 <= a < 64 for a, b in places)


def likeness_brute(rows):
    order = sorted(((r[0], r[1] or "") for r in rows), key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    for at, (doc_id, text) in enumerate(order):
        following = order[(at + 1) % len(order)][1]
        third = len(text) // 3
        edited = text[:len(text) - third] + following[:third]
        prints = [winnow_brute(t, 16, 64) for t in (text, edited, following)]
        sets = [{h for h, _ in p} for p in prints]
        like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
        shown = [" ".join(f"{h:012x}@{p:x}" for h, p in found) for found in prints[:2]]
        yield (doc_id, len(text), sha256(edited.encode()).hexdigest(), *shown, like(sets[0], sets[1]), like(sets[0], sets[2]))


@pytest.mark.parametrize("range_bytes", [1 << 30, 2000, 200])
def test_edit_likeness_equals_brute_force(spark, range_bytes):
    # Rows of one id are ordered by a hash of the text, so those with other texts are left to the next test.
    rows = [r for r in awkward_rows(count=40) if r[0] is not None]
    table = clashing(docs(spark, rows).repartition(4), ["block", "borrowed", "tie", "copy", "fingerprint", "n_chars"])
    got = edit_likeness(table, range_bytes=range_bytes)
    assert ordered(collected(got)) == ordered(likeness_brute(rows))


def test_likeness_of_rows_without_id_and_small_tables(spark):
    assert edit_likeness(docs(spark, [])).collect() == []
    alone = edit_likeness(docs(spark, [(5, "some words of a text", "en", "s", 1)])).first()
    assert (alone.near_edited, alone.near_next) == (0.0, 1.0) and alone.edited_sha256 == sha256(b"some words of some w").hexdigest()
    rows = awkward_rows(count=20) + [(None, f"unnamed {i}", None, None, None) for i in range(30)]
    for size in (1 << 30, 100):
        got = edit_likeness(docs(spark, rows), range_bytes=size).collect()
        assert sorted((r.doc_id is None, r.doc_id or 0, r.n_chars) for r in got) == sorted(
            (r[0] is None, r[0] or 0, len(r[1] or "")) for r in rows)
    same = [r for r in fingerprints(docs(spark)).collect() if r.doc_id in (207, 208)]
    assert same[0].fingerprint == same[1].fingerprint and same[0].n_fingerprints == 1


def test_edited_texts_are_alike_and_other_texts_are_not():
    rnd = random.Random(8)
    prose = lambda n: " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 9))) for _ in range(n))
    for _ in range(20):
        one, other = prose(400), prose(300)
        mine, edited, next_one = (winnow(t)[0] for t in (one, edited_text(one, other), other))
        assert 0.35 < likeness(mine, edited) < 0.65 and likeness(mine, next_one) < 0.02
