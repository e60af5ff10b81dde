"""Token counts and packing, against the tokenizer libraries."""

import os
import sys
from zlib import crc32

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))
from helpers import awkward_rows, clashing, docs  # noqa: E402

from loomledger.llm.packing import cut_lengths, pack_documents  # noqa: E402
from loomledger.llm.token_counts import CHUNK, END, GOES, Transducer, pretoken_starts, scan_maps, state_maps, token_counts  # noqa: E402
from loomledger.llm.tokenizers_io import load_tokenizer, vocabulary_path  # noqa: E402


def library_ids(name, texts):
    return [e.ids for e in load_tokenizer(vocabulary_path(name)).encode_batch(list(texts), add_special_tokens=False)]


def test_counts_equal_the_library(spark):
    rows = awkward_rows()
    extra = ["'s't re 'll've  x", "a" * 300, "  \n\t 1'd", "<|endoftext|>" * 3 + "<|", "!!''s", "Ã" * 200 + "Â" * 90, "12 345", "a\x85b\x1cc"]
    rows += [(300 + i, text, "en", "s", 1) for i, text in enumerate(extra)]
    expected = sorted((r[0] or -1, len((r[1] or "").encode()), len(ids), len(ids) > 512)
                      for r, ids in zip(rows, library_ids("byte_bpe_50k.json", [r[1] or "" for r in rows]), strict=True))
    got = token_counts(clashing(docs(spark, rows), ["n_bytes", "n_tokens", "over_limit"]))
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert sorted((r[0] or -1, *r[1:]) for r in got.collect()) == expected


def test_counts_of_an_empty_table(spark):
    assert token_counts(docs(spark, [])).collect() == []


def test_scanned_maps_equal_one_walk():
    rng = np.random.default_rng(5)
    classes = rng.integers(0, END + 1, 5 * CHUNK).astype(np.uint8)
    maps = scan_maps(state_maps(np.ascontiguousarray(classes.reshape(5, CHUNK).T)))
    state = 0
    for i, kind in enumerate(classes):
        state = GOES[state, kind]
        if (i + 1) % CHUNK == 0:
            assert maps[i // CHUNK, 0] == state
    assert pretoken_starts(classes)[0] == 0


def test_long_and_short_walks_agree():
    transducer = Transducer(vocabulary_path("byte_bpe_50k.json"))
    rng = np.random.default_rng(3)
    words = [bytes(rng.choice(list(b"etaoinshr th"), n)) for n in range(1, 60)]
    assert transducer.count_pretokens(words).tolist() == [transducer.count_long(word) for word in words]


@pytest.mark.parametrize("tokens", [1, 2047, 2048, 2049, 5000])
def test_cuts_are_whole_or_powers_of_two(tokens):
    lengths = cut_lengths(tokens, 2048)
    assert sum(lengths) == tokens and all(n & (n - 1) == 0 for n in lengths)


@pytest.mark.parametrize("partitions", [1, 5])
def test_packing_is_an_exact_round_trip_without_padding(spark, partitions):
    rows = awkward_rows()
    packed = pack_documents(clashing(docs(spark, rows).repartition(partitions), ["start", "length"])).collect()
    ids = {}
    for row, tokens in zip(rows, library_ids("word_bpe_49k.json", [r[1] or "" for r in rows]), strict=True):
        ids.setdefault(row[0], []).append([*tokens, 1])
    sequences = {}
    by_doc = {}
    for row in packed:
        by_doc.setdefault(row.doc_id, []).append(row)
        sequences.setdefault(row.sequence_id, []).append((row.offset, row.length, row.sequence_length))
    for parts in sequences.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048 and at & (at - 1) == 0 and at == parts[0][2]
    assert set(by_doc) == set(ids)
    for doc_id, copies in ids.items():
        pieces = sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in by_doc[doc_id])
        assert sum(p[1] for p in pieces) == sum(len(tokens) for tokens in copies)
        sums = {(s, n, crc32(np.array(t[s:s + n], "<u4").tobytes()), len(t)) for t in copies for s, n, *_ in pieces}
        assert all(piece in sums for piece in pieces)


def test_packing_an_empty_table_and_a_wrong_capacity(spark):
    assert pack_documents(docs(spark, [])).collect() == []
    with pytest.raises(ValueError):
        pack_documents(docs(spark, []), capacity=1000)
