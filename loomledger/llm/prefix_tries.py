"""Prefix trie of conversations: double-array tries per shard, merged over shards.

A conversation is its sequence of turns (role and text). A node is a distinct
sequence of first turns, named by its depth and a 128-bit hash of that sequence.

1. Turns are ranked within their conversation over many tasks (``ordered.ranked``),
   which also gives every turn the running hash of all turns up to it. A conversation
   is cut into segments of ``SEGMENT`` turns, so that one of any length is many rows.
2. Segments are dealt to shards by range of their first turns, then conversation id:
   equal beginnings come together, and a beginning that a third of all conversations
   share fills several shards. Of at most ``BLOCK`` turns at a time a shard builds a
   trie: turns get dense ids, BASE and CHECK are packed over them, and all segments
   walk the arrays a turn at a time. Every state reached is a node, with what its
   members in the shard add up to.
3. Nodes that several shards hold, above all the upper ones, meet by their names.

Sums over subtrees need no walk of the merged tree. A node's weight is given to its
smallest member. Below a node v the weights then are, for each conversation through
v, those that it was given at v's depth or deeper; as it was given a node only from
some depth on, this is its weight from v's depth on. So a second walk through the same
tries adds up one number per conversation and depth, and the shards' sums are merged
as before.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomledger.llm.common import require_columns, settle, ship_package
from loomledger.llm.ordered import ranked

SEGMENT = 256
BLOCK = 100_000
#: Parents of more children than this are sent to all tasks; there is at most one for so many nodes.
MANY_CHILDREN = 10_000
#: Conversation ids of one chunk of a node's list of ends, a power of two.
CHUNK_BITS = 10
NAME = ["depth", "path_a", "path_b"]


# --- double arrays ----------------------------------------------------------------


class DoubleArray:
    """A trie over dense ids: from state s by id i to state t = base[s] + i, if check[t] == s."""

    def __init__(self, sequences: list[np.ndarray], n_ids: int) -> None:
        """Pack the trie of ``sequences`` of ids 0 .. n_ids - 1, level by level; the root is state 0."""
        self.base = np.zeros(1, dtype=np.int64)
        self.check = np.full(1, -1, dtype=np.int64)
        self.check[0] = 0
        self._free: list[int] = []
        self._end = 1
        lengths = np.array([len(s) for s in sequences])
        state = np.zeros(len(sequences), dtype=np.int64)
        for level in range(int(lengths.max(initial=0))):
            active = np.flatnonzero(lengths > level)
            ids = np.array([sequences[a][level] for a in active], dtype=np.int64)
            edges = np.unique(state[active] * n_ids + ids)
            parents, symbols = edges // n_ids, edges % n_ids
            starts = np.flatnonzero(np.concatenate([[True], parents[1:] != parents[:-1]]))
            for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(edges)], strict=True):
                self._attach(int(parents[start]), symbols[start:end])
            state[active] = self.base[state[active]] + ids

    def _attach(self, parent: int, symbols: np.ndarray) -> None:
        """Give ``parent`` its children: a hole for one, a place at the end for several."""
        low = int(symbols[0])
        if len(symbols) == 1 and self._free:
            base = self._free.pop() - low
        else:
            base = self._end - low
            last = base + int(symbols[-1])
            self._grow(last + 1)
            taken = base + symbols
            if len(symbols) > 1:
                self._free.extend(np.setdiff1d(np.arange(self._end, last), taken, assume_unique=True).tolist())
            self._end = last + 1
        self.base[parent] = base
        self.check[base + symbols] = parent

    def _grow(self, size: int) -> None:
        if size > len(self.base):
            more = max(size, 2 * len(self.base)) - len(self.base)
            self.base = np.concatenate([self.base, np.zeros(more, dtype=np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, dtype=np.int64)])

    def step(self, states: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The states after one more id each; -1 where there is none."""
        after = self.base[states] + ids
        inside = (after > 0) & (after < len(self.check))
        after = np.where(inside, after, 0)
        return np.where(inside & (self.check[after] == states), after, -1)


def walk(sequences: list[np.ndarray], n_ids: int) -> tuple[DoubleArray, list[tuple[np.ndarray, np.ndarray]]]:
    """The trie of ``sequences`` and, per level, (sequences that reach it, their states)."""
    trie = DoubleArray(sequences, n_ids)
    lengths = np.array([len(s) for s in sequences])
    state, levels = np.zeros(len(sequences), dtype=np.int64), []
    for level in range(int(lengths.max(initial=0))):
        active = np.flatnonzero(lengths > level)
        state[active] = trie.step(state[active], np.array([sequences[a][level] for a in active], dtype=np.int64))
        levels.append((active, state[active].copy()))
    return trie, levels


# --- shards -----------------------------------------------------------------------


def _lists(column: pa.Array) -> list[np.ndarray]:
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)
    return [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def _blocks(batches: Iterator[pa.RecordBatch], names: list[str], most: int) -> Iterator[dict]:
    """Columns of segments with at most ``most`` turns together, or one segment."""
    held: dict[str, list] = {name: [] for name in names}
    turns = 0
    for batch in batches:
        columns = {}
        for name in names:
            column = batch.column(name)
            columns[name] = _lists(column) if pa.types.is_list(column.type) else column.to_pylist()
        for at in range(batch.num_rows):
            count = len(columns["key"][at]) + 1
            if turns and turns + count > most:
                yield held
                held, turns = {name: [] for name in names}, 0
            for name in names:
                held[name].append(columns[name][at])
            turns += count
    if turns:
        yield held


def _tries(block: dict) -> Iterator[tuple[np.ndarray, np.ndarray, int, np.ndarray, np.ndarray]]:
    """Per level of a block's trie: (its nodes' first segments, depths, level, segments, node numbers of those).

    The stem of a segment (what precedes it) is its first id, so segments of
    different beginnings or depths never share a node.
    """
    count = len(block["key"])
    stems = np.array([f"{d} {a} {b}" for d, a, b in zip(block["start"], block["stem_a"], block["stem_b"], strict=True)])
    _, stem_ids = np.unique(stems, return_inverse=True)
    keys = np.concatenate(block["key"]) if count else np.zeros(0, dtype=np.int64)
    distinct, ids = np.unique(keys, return_inverse=True)
    n_stems = int(stem_ids.max()) + 1
    ends = np.cumsum([len(k) for k in block["key"]])
    sequences = [np.concatenate([[stem_ids[at]], ids[end - len(block["key"][at]):end] + n_stems])
                 for at, end in enumerate(ends.tolist())]
    _, levels = walk(sequences, n_stems + len(distinct))
    starts = np.array(block["start"], dtype=np.int64)
    for level, (segments, states) in enumerate(levels):
        _, first, number = np.unique(states, return_index=True, return_inverse=True)
        yield segments[first], starts[segments[first]] + level, level, segments, number


def _taken(lists: list[np.ndarray], segments: np.ndarray, at: int) -> np.ndarray:
    return np.array([lists[s][at] for s in segments], dtype=np.int64)


_NODE = pa.schema([("depth", pa.int64()), ("path_a", pa.int64()), ("path_b", pa.int64()), ("parent_a", pa.int64()),
                   ("parent_b", pa.int64()), ("chars", pa.int64()), ("conv_id", pa.int64()), ("n_convs", pa.int64())])
_SUM = pa.schema([("depth", pa.int64()), ("path_a", pa.int64()), ("path_b", pa.int64()), ("leaves", pa.int64()),
                  ("saved", pa.int64())])


def _levels(block: dict) -> Iterator[tuple]:
    """(first segments, depths, paths a, paths b, level, segments, node numbers) of the nodes a block is to report.

    Level 0 is the stem: a node of its own only for the root, as any other is the last of the segment before.
    """
    for first, depths, level, segments, number in _tries(block):
        if level:
            a, b = _taken(block["path_a"], first, level - 1), _taken(block["path_b"], first, level - 1)
            yield first, depths, a, b, level, segments, number
        elif (depths == 0).any():
            root = int(np.flatnonzero(depths == 0)[0])
            held = number == root
            zero = np.zeros(1, dtype=np.int64)
            yield first[[root]], depths[[root]], zero, zero, 0, segments[held], np.zeros(int(held.sum()), dtype=np.int64)


def _node_task(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    for block in _blocks(batches, ["conv_id", "start", "stem_a", "stem_b", "key", "path_a", "path_b", "chars"], most):
        convs = np.array(block["conv_id"], dtype=np.int64)
        for first, depths, a, b, level, segments, number in _levels(block):
            least = np.full(len(first), np.iinfo(np.int64).max)
            np.minimum.at(least, number, convs[segments])
            if level > 1:
                parents = [_taken(block[n], first, level - 2) for n in ("path_a", "path_b")]
            else:
                parents = [np.array([block[n][s] for s in first], dtype=np.int64) for n in ("stem_a", "stem_b")]
            chars = _taken(block["chars"], first, level - 1) if level else np.zeros(len(first), dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (depths, a, b, *parents, chars, least, np.bincount(number, minlength=len(first)))],
                schema=_NODE)


def _sum_task(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    names = ["start", "stem_a", "stem_b", "key", "path_a", "path_b", "given_depth", "given_weight", "given_leaf", "rest", "rest_leaf"]
    for block in _blocks(batches, names, most):
        # Per segment and depth what the conversation was given from there on, later segments included.
        onward = []
        for at, key in enumerate(block["key"]):
            weights = np.zeros(len(key) + 1, dtype=np.int64)
            weights[block["given_depth"][at] - block["start"][at]] = block["given_weight"][at]
            onward.append(np.cumsum(weights[::-1])[::-1] + block["rest"][at])
        leaves = np.array(block["given_leaf"], dtype=np.int64) + np.array(block["rest_leaf"], dtype=np.int64)
        for first, depths, a, b, level, segments, number in _levels(block):
            saved, found = np.zeros(len(first), dtype=np.int64), np.zeros(len(first), dtype=np.int64)
            np.add.at(saved, number, _taken(onward, segments, level))
            np.add.at(found, number, leaves[segments])
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (depths, a, b, found, saved)], schema=_SUM)


def _hash_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of every node's ends, chunk after chunk as they come sorted."""
    schema = pa.schema([("depth", pa.int64()), ("path_a", pa.int64()), ("path_b", pa.int64()), ("ends_sha256", pa.string())])
    node, state, out = None, None, []
    for batch in batches:
        names = zip(*[batch.column(n).to_pylist() for n in NAME], strict=True)
        for name, text in zip(names, batch.column("ends").to_pylist(), strict=True):
            if name != node:
                if node is not None:
                    out.append((*node, state.hexdigest()))
                node, state = name, sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out = []
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*node, state.hexdigest()), schema)], schema=schema)


# --- conversations ----------------------------------------------------------------


def turn_rows(turns: DataFrame) -> DataFrame:
    """Turns of conversations with an id: conv_id, turn, key (digest of role and text), chars; nulls are empty."""
    require_columns(turns, ["conv_id", "turn", "role", "text"])
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    content = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return turns.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.unhex(F.sha2(content, 256)).alias("key"), F.length(text).cast("long").alias("chars"))


def positions(turns: DataFrame) -> DataFrame:
    """``turn_rows`` with the place of each turn in its conversation: null turns first, equal ones by digest."""
    placed = ranked(turn_rows(turns), ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("key").asc()])
    return placed.select("conv_id", F.col("rank").alias("place"), "key", "chars")


def borrowed_starts(placed: DataFrame, lender: Column, count: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first ``count`` (at most ``most``) turns are those of conversation ``lender``.

    Returns the ids of all conversations, and (conv_id, place, key, chars) of the rebuilt ones: the
    lender's first turns (all if fewer, none if it is absent), then the own turns after as many of their own.
    """
    convs = placed.filter("place = 0").select("conv_id", lender.alias("_lender"), count.cast("long").alias("_count"))
    heads = placed.filter(F.col("place") < most).select(F.col("conv_id").alias("_lender"), "place", "key", "chars")
    taken = convs.join(heads, "_lender").filter(F.col("place") < F.col("_count")).select("conv_id", "place", "key", "chars")
    lent = heads.groupBy("_lender").agg(F.count(F.lit(1)).alias("_has"))
    # Only conversations that borrow less than they give up move their own turns forward.
    missing = F.col("_count") - F.least(F.col("_count"), F.coalesce("_has", F.lit(0)))
    moved = convs.join(lent, "_lender", "left").select("conv_id", missing.alias("_missing")).filter("_missing > 0")
    own = placed.filter(F.col("place") >= count).join(moved, "conv_id", "left").select(
        "conv_id", (F.col("place") - F.coalesce("_missing", F.lit(0))).alias("place"), "key", "chars")
    return convs.select("conv_id"), own.union(taken)


def _segments(convs: DataFrame, placed: DataFrame, segment: int) -> DataFrame:
    """conv_id, number, start, stem, and the keys, paths and lengths of a segment's turns.

    Every conversation has segment 0, empty where it has no turns.
    """
    hashed = placed.withColumns({"path_a": F.xxhash64("place", "key"), "path_b": F.xxhash64("key", "place", F.lit("b"))})
    turns = ranked(hashed.withColumns({"own_a": F.col("path_a"), "own_b": F.col("path_b")}),
                   ["conv_id"], [F.col("place").asc()], xor=["path_a", "path_b"])
    number = F.expr(f"place div {segment}")
    first = F.sort_array(F.collect_list(F.struct("place", F.xxhash64("key").alias("key"), "path_a", "path_b", "chars",
                                                 "own_a", "own_b"))).alias("_turns")
    cut = turns.groupBy("conv_id", number.alias("number")).agg(first)
    empty = convs.join(placed.filter("place = 0").select("conv_id"), "conv_id", "left_anti").select(
        "conv_id", F.lit(0).cast("long").alias("number"), F.array().cast(cut.schema["_turns"].dataType).alias("_turns"))
    stem = lambda x: F.coalesce(F.get("_turns", 0)[f"path_{x}"].bitwiseXOR(F.get("_turns", 0)[f"own_{x}"]), F.lit(0))
    return cut.unionByName(empty).select(
        "conv_id", "number", (F.col("number") * segment).alias("start"), stem("a").alias("stem_a"), stem("b").alias("stem_b"),
        *[F.col(f"_turns.{name}").alias(name) for name in ("key", "path_a", "path_b", "chars")])


def _sharded(segments: DataFrame) -> DataFrame:
    """Equal beginnings side by side; within them by conversation, where a shard may end."""
    order = ["start", "stem_a", "stem_b", *[F.get("path_a", at) for at in range(3)], "conv_id"]
    return segments.repartitionByRange(*order).sortWithinPartitions(*order)


def _joined(nodes: DataFrame, other: DataFrame) -> DataFrame:
    return nodes.join(other, NAME, "left")


def _with_parents(nodes: DataFrame, children: DataFrame) -> DataFrame:
    """``nodes`` with the smallest member of the parent. Parents of very many children are looked up without a shuffle."""
    parents = _joined(nodes.select(*NAME, "conv_id"), children).filter("n_children > 0").select(
        F.col("depth").alias("_depth"), F.col("path_a").alias("parent_a"), F.col("path_b").alias("parent_b"),
        F.col("conv_id").alias("parent_conv_id"), "n_children")
    key = ["_depth", "parent_a", "parent_b"]
    below = nodes.withColumn("_depth", F.col("depth") - 1)
    wide = parents.filter(F.col("n_children") > MANY_CHILDREN).select(*key, F.col("parent_conv_id").alias("_wide"))
    known = below.join(F.broadcast(wide), key, "left")
    narrow = parents.filter(F.col("n_children") <= MANY_CHILDREN).select(*key, "parent_conv_id")
    rest = known.filter("_wide is null").join(narrow, key, "left")
    return known.filter("_wide is not null").withColumn("parent_conv_id", F.col("_wide")).select(
        *nodes.columns, "parent_conv_id").union(rest.select(*nodes.columns, "parent_conv_id"))


def prefix_nodes(convs: DataFrame, placed: DataFrame, segment: int = SEGMENT, block: int = BLOCK) -> DataFrame:
    """One row per node of the prefix trie of conversations ``convs`` with turns ``placed`` (conv_id, place, key, chars).

    conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs,
    n_children, n_leaves (childless nodes of the subtree), saved_tokens (over the
    subtree, members beyond the first times the code points of the last text) and
    ends_sha256 (of the ids of conversations that end here, ascending, joined by commas).
    """
    ship_package(convs.sparkSession)
    segments = settle(_segments(convs, placed, segment), "segments")
    found = _sharded(segments).mapInArrow(
        lambda batches: _node_task(batches, block),
        "depth long, path_a long, path_b long, parent_a long, parent_b long, chars long, conv_id long, n_convs long")
    nodes = settle(found.groupBy(*NAME).agg(
        F.min("parent_a").alias("parent_a"), F.min("parent_b").alias("parent_b"), F.max("chars").alias("chars"),
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs")), "nodes")
    children = settle(nodes.filter("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("parent_a").alias("path_a"), F.col("parent_b").alias("path_b")).agg(
            F.count(F.lit(1)).alias("n_children")), "children")

    # What the smallest member of each node is given, by segment of that conversation.
    weighed = _joined(nodes, children).select(
        "conv_id", "depth", ((F.col("n_convs") - 1) * F.col("chars")).alias("weight"),
        F.col("n_children").isNull().cast("long").alias("leaf"))
    number = F.greatest(F.expr(f"(depth - 1) div {segment}"), F.lit(0))
    given = weighed.groupBy("conv_id", number.alias("number")).agg(
        F.collect_list(F.struct("depth", "weight")).alias("_given"), F.sum("weight").alias("_weight"),
        F.sum("leaf").alias("given_leaf"))
    none = F.array().cast("array<bigint>")
    later = Window.partitionBy("conv_id").orderBy("number").rowsBetween(1, Window.unboundedFollowing)
    carried = segments.join(given, ["conv_id", "number"], "left").withColumns({
        "given_depth": F.coalesce("_given.depth", none), "given_weight": F.coalesce("_given.weight", none),
        "given_leaf": F.coalesce("given_leaf", F.lit(0)),
        "rest": F.coalesce(F.sum("_weight").over(later), F.lit(0)),
        "rest_leaf": F.coalesce(F.sum("given_leaf").over(later), F.lit(0))}).drop("_given", "_weight")
    sums = _sharded(carried).mapInArrow(
        lambda batches: _sum_task(batches, block), "depth long, path_a long, path_b long, leaves long, saved long")
    sums = sums.groupBy(*NAME).agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))

    last = F.size("path_a")
    length = F.max(F.col("start") + last)
    ends = segments.groupBy("conv_id").agg(
        length.alias("depth"), F.max_by(F.struct(F.coalesce(F.get("path_a", last - 1), "stem_a").alias("a"),
                                                 F.coalesce(F.get("path_b", last - 1), "stem_b").alias("b")), "number").alias("_path"))
    ids = F.sort_array(F.collect_list("conv_id"))
    chunks = ends.groupBy("depth", F.col("_path.a").alias("path_a"), F.col("_path.b").alias("path_b"),
                          F.shiftright("conv_id", CHUNK_BITS).alias("chunk")).agg(F.array_join(ids.cast("array<string>"), ",").alias("ends"))
    hashes = chunks.repartition(*NAME).sortWithinPartitions(*NAME, "chunk").mapInArrow(
        _hash_task, "depth long, path_a long, path_b long, ends_sha256 string")

    whole = _joined(_joined(_joined(_with_parents(nodes, children), children), sums), hashes)
    return whole.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def conversation_trie(turns: DataFrame, segment: int = SEGMENT, block: int = BLOCK) -> DataFrame:
    """``prefix_nodes`` of the conversations as they stand.

    Null roles and texts are empty; rows without a conversation id take no part;
    turns of equal number are ordered by the digest of role and text, and repeated
    rows are turns of their own. An empty table has no nodes. Other columns are
    ignored, whatever their names.
    """
    placed = settle(positions(turns), "turns")
    return prefix_nodes(placed.filter("place = 0").select("conv_id"), placed, segment, block)


def family_trie(turns: DataFrame, family: int = 100, most: int = 5, segment: int = SEGMENT, block: int = BLOCK) -> DataFrame:
    """``prefix_nodes`` of conversations that share the beginning of the first of their family.

    Conversation c takes the first h turns of conversation c - c % ``family`` in place of
    its own first h, where h is the CRC-32 of c's decimal digits modulo ``most`` + 1. Nulls,
    ties, repeats and empty tables are as in ``conversation_trie``.
    """
    placed = settle(positions(turns), "turns")
    conv = F.col("conv_id")
    count = F.crc32(conv.cast("string").cast("binary")) % (most + 1)
    convs, rebuilt = borrowed_starts(placed, conv - conv % family, count, most)
    return prefix_nodes(settle(convs, "convs"), settle(rebuilt, "rebuilt"), segment, block)
