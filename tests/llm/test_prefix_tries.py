"""The prefix trie of conversations against brute force."""

import collections
import os
import random
import sys
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))
from helpers import clashing, collected  # noqa: E402

from loomledger.llm.prefix_tries import DoubleArray, conversation_trie, family_trie, walk  # noqa: E402
from loomledger.llm.queries import ORACLE_SQL, QUERIES  # noqa: E402

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turns_of(rows):
    found = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            found[conv].append((turn is not None, turn or 0, key, (role, text)))
    return {conv: [t[3] for t in sorted(turns)] for conv, turns in found.items()}


def trie_brute(convs):
    members = collections.defaultdict(list)
    for conv, turns in convs.items():
        for depth in range(len(turns) + 1):
            members[turns[:depth]].append(conv)
    children = collections.Counter(path[:-1] for path in members if path)
    leaves, saved = collections.Counter(), collections.Counter()
    for path, held in members.items():
        for depth in range(len(path) + 1):
            leaves[path[:depth]] += not children[path]
            saved[path[:depth]] += (len(held) - 1) * (len(path[-1][1]) if path else 0)
    return sorted((min(held), len(path), min(members[path[:-1]]) if path else -1, len(held), children[path], leaves[path], saved[path],
                   sha256(",".join(str(c) for c in sorted(held) if convs[c] == path).encode()).hexdigest())
                  for path, held in members.items())


def plain_brute(rows):
    return trie_brute({conv: tuple(turns) for conv, turns in turns_of(rows).items()})


def family_brute(rows):
    own = turns_of(rows)
    count = {conv: crc32(str(conv).encode()) % 6 for conv in own}
    return trie_brute({c: tuple(own.get(c - c % 100, [])[:count[c]] + own[c][count[c]:]) for c in own})


def rows_of(df):
    return sorted(tuple(-1 if v is None else v for v in row) for row in collected(df.select(*COLUMNS)))


def awkward_turns(seed=3):
    """Shared beginnings, copies, nulls, ties, repeats, long texts, missing lenders, one long conversation."""
    rnd = random.Random(seed)
    said = ["", "yes", "no", "tell me", "x" * 3000, "ünï 😀"]
    rows = [(conv, turn, rnd.choice(["user", "assistant"]), rnd.choice(said))
            for conv in [*range(60), *range(205, 230), 1300] for turn in range(rnd.randint(1, 8))]
    rows += [(conv, turn, "user", "same") for conv in range(400, 440) for turn in range(4)]
    rows += [(77, turn, "user", f"t{turn % 5}") for turn in range(45)]
    rows += [(78, turn, "user", f"t{turn % 5}") for turn in range(33)]
    rows += [(90, None, None, None), (90, None, "user", None), (90, 0, None, "a"), (90, 0, "user", "b"), (90, 0, "user", "b"),
             (91, 3, "user", "b"), (91, 3, "user", "a"), (91, -1, "", "c"), (None, 1, "user", "lost"), (None, None, None, None)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("segment,block", [(256, 100_000), (7, 60), (1, 1)])
def test_tries_equal_brute_force(spark, segment, block):
    rows = awkward_turns()
    table = clashing(spark.createDataFrame(rows, SCHEMA).repartition(4), ["depth", "place", "key", "path_a", "rank", "number", "chars"])
    assert rows_of(conversation_trie(table, segment, block)) == plain_brute(rows)
    assert rows_of(family_trie(table, segment=segment, block=block)) == family_brute(rows)


@pytest.mark.parametrize("rows", [[], [(None, 1, "u", "x")], [(5, 0, "u", "x")], [(5, 0, "u", "x"), (8, 0, "u", "x"), (8, 1, "u", "y")]],
                         ids=["empty", "no id", "one", "two"])
def test_small_tries(spark, rows):
    table = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(family_trie(table)) == family_brute(rows)
    assert rows_of(conversation_trie(table)) == plain_brute(rows)


def test_trie_equals_sql(spark, duck, sf_dir):
    got = rows_of(QUERIES["op11_prefix_trie"](spark, sf_dir))
    names = ", ".join(COLUMNS)
    expected = duck.execute(f"SELECT {names} FROM ({ORACLE_SQL['op11_prefix_trie']})").fetchall()
    assert got == sorted(tuple(-1 if v is None else v for v in row) for row in expected)


def test_double_array_holds_exactly_the_prefixes():
    rnd = random.Random(2)
    for _ in range(20):
        n = rnd.randint(1, 30)
        sequences = [np.array([rnd.randrange(n) for _ in range(rnd.randint(0, 6))], dtype=np.int64) for _ in range(60)]
        trie, levels = walk(sequences, n)
        prefixes = {tuple(s[:d].tolist()) for s in sequences for d in range(1, len(s) + 1)}
        assert len({(level, int(s)) for level, (_, states) in enumerate(levels) for s in states}) == len(prefixes)
        assert (trie.check >= 0).sum() == len(prefixes) + 1
        for _ in range(50):
            state, probe = np.array([0]), [rnd.randrange(n) for _ in range(rnd.randint(1, 5))]
            for symbol in probe:
                if state[0] >= 0:
                    state = trie.step(state, np.array([symbol]))
            assert (state[0] >= 0) == (tuple(probe) in prefixes)
    assert len(DoubleArray([], 1).check) == 1
