"""Merkle manifest of a table of documents, by time-forward processing.

Every document is a leaf. The leaves of a source form a tree of three children a
node, and the roots of the sources, in order, form one more. Nodes are labelled by
(tree, level, index); a label is larger than those of all it depends on. Two sweeps
pass along the labels:

1. *Upwards* each node takes its children's digests from a priority queue ordered by
   the label of the receiver, and sends its own digest to its parent.
2. *Downwards*, in the reverse order, each node takes from the queue the part of the
   proof that its leaves share, and sends it, with the siblings added, to its children.

The queue is external. Within an aligned block of ``3**BLOCK_LEVELS`` nodes it is a
heap in one task; from block to block it is Spark's sorted shuffle by (tree, block).
A round of blocks climbs ``BLOCK_LEVELS`` levels, so the number of rounds is that of
the leaves' logarithm to the base 6,561 and no task holds more than a block. A source
that holds a third of all rows is ranked over many tasks (``ordered.ranked``) and
then consists of as many blocks as its size asks for.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomledger.llm.common import require_columns, settle, ship_package
from loomledger.llm.ordered import ranked

FAN = 3
BLOCK_LEVELS = 8
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
_UP = "tree string, count long, index long, digest binary"
_DOWN = "tree string, index long, path binary, subroot binary, root binary"
_LEAVES = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
           "verified boolean, proof binary")


# --- one block -------------------------------------------------------------------


def levels_of(count: int, block_levels: int) -> int:
    """The levels that a block climbs in a tree of ``count`` nodes: all of them where the tree is one block."""
    levels = 0
    while count > 1 and levels < block_levels:
        count = -(-count // FAN)
        levels += 1
    return levels


def sweep_up(digests: list[bytes], levels: int) -> dict[tuple[int, int], bytes]:
    """The digest (hex text) of every node of a block by label (level, index)."""
    nodes: dict[tuple[int, int], bytes] = {}
    queue = [((0, at), at, digest) for at, digest in enumerate(digests)]  # (label of the receiver, slot, digest)
    while queue:
        label = queue[0][0]
        received = []
        while queue and queue[0][0] == label:
            received.append(heapq.heappop(queue)[2])
        level, index = label
        nodes[label] = received[0] if level == 0 else sha256(b"".join(received)).hexdigest().encode()
        if level < levels:
            heapq.heappush(queue, ((level + 1, index // FAN), index, nodes[label]))
    return nodes


def sweep_down(nodes: dict[tuple[int, int], bytes], levels: int, suffix: bytes) -> list[bytes]:
    """The path of every bottom node: its siblings up to the block's top, then ``suffix``."""
    paths: dict[int, bytes] = {}
    queue = [((-levels, 0), suffix)]  # labels negated: the largest comes first
    while queue:
        (level, index), path = heapq.heappop(queue)
        level, index = -level, -index
        if level == 0:
            paths[index] = path
            continue
        run = [child for child in range(index * FAN, index * FAN + FAN) if (level - 1, child) in nodes]
        for at, child in enumerate(run):
            others = [bytes.fromhex(nodes[level - 1, other].decode()) for other in run if other != child]
            entry = bytes([at, len(others) - at]) + b"".join(others)
            heapq.heappush(queue, ((-(level - 1), -child), entry + path))
    return [paths[at] for at in range(len(paths))]


def steps(path: bytes) -> Iterator[tuple[bytes, bytes]]:
    """The (left, right) siblings of a path as hex text, level by level.

    A path is, per level: the numbers of left and of right siblings, one byte each, and their digests.
    """
    at = 0
    while at < len(path):
        left, right = path[at], path[at + 1]
        middle, end = at + 2 + 32 * left, at + 2 + 32 * (left + right)
        yield path[at + 2:middle].hex().encode(), path[middle:end].hex().encode()
        at = end


def fold(digest: bytes, path: bytes) -> bytes:
    """The root that a leaf's digest (hex text) and its path lead to."""
    for left, right in steps(path):
        digest = sha256(left + digest + right).hexdigest().encode()
    return digest


# --- blocks of one partition -------------------------------------------------------


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of one (tree, block) after another, as they come sorted."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and (row["tree"], row["block"]) != (held[0]["tree"], held[0]["block"]):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _batches(rows: Iterator[dict], schema: pa.Schema, at_once: int = 5000) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= at_once:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    yield pa.RecordBatch.from_pylist(held, schema)


def _hex(row: dict) -> bytes:
    return row["digest"].hex().encode()


def _up_task(batches: Iterator[pa.RecordBatch], block_levels: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("tree", pa.string()), ("count", pa.int64()), ("index", pa.int64()), ("digest", pa.binary())])

    def tops() -> Iterator[dict]:
        for rows in _blocks(batches):
            levels = levels_of(rows[0]["count"], block_levels)
            top = sweep_up([_hex(r) for r in rows], levels)[levels, 0]
            yield {"tree": rows[0]["tree"], "count": -(-rows[0]["count"] // FAN**block_levels), "index": rows[0]["block"],
                   "digest": bytes.fromhex(top.decode())}

    yield from _batches(tops(), schema)


def _paths(batches: Iterator[pa.RecordBatch], block_levels: int) -> Iterator[tuple[dict, dict, bytes]]:
    """(head, node, path) of every node; a block's head comes before its nodes."""
    for head, *rows in _blocks(batches):
        levels = levels_of(rows[0]["count"], block_levels)
        nodes = sweep_up([_hex(r) for r in rows], levels)
        for row, path in zip(rows, sweep_down(nodes, levels, head["path"]), strict=True):
            yield head, row, path


def _down_task(batches: Iterator[pa.RecordBatch], block_levels: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("tree", pa.string()), ("index", pa.int64()), ("path", pa.binary()), ("subroot", pa.binary()),
                        ("root", pa.binary())])
    # A node of the tree of sources carries the name of its own tree; its digest is that tree's root.
    yield from _batches(({
        "tree": row["tree"] if row["name"] is None else row["name"],
        "index": row["index"] if row["name"] is None else 0, "path": path,
        "subroot": head["subroot"] if row["name"] is None else row["digest"], "root": head["root"],
    } for head, row, path in _paths(batches, block_levels)), schema)


def _leaf_task(batches: Iterator[pa.RecordBatch], block_levels: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), *[(name, pa.string()) for name in (
        "leaf", "subroot", "root", "proof_sha256", "folded_root")], ("verified", pa.bool_()), ("proof", pa.binary())])

    def leaves() -> Iterator[dict]:
        for head, row, path in _paths(batches, block_levels):
            root = head["root"].hex()
            folded = fold(row["altered"].hex().encode(), path).decode()
            yield {"doc_id": row["doc_id"], "leaf": row["digest"].hex(), "subroot": head["subroot"].hex(), "root": root,
                   "proof_sha256": sha256(b"".join(left + right for left, right in steps(path))).hexdigest(),
                   "folded_root": folded, "verified": folded == root, "proof": path}

    yield from _batches(leaves(), schema, 500)


# --- rounds -----------------------------------------------------------------------


def _climb(nodes: DataFrame, block_levels: int) -> tuple[list[tuple[DataFrame, DataFrame]], DataFrame]:
    """Rounds of (nodes, trees finished in the round), and the digest of every tree's root."""
    rounds, roots = [], None
    while True:
        blocks = nodes.select("tree", "count", _block(block_levels), "index", "digest")
        tops = settle(blocks.repartition("tree", "block").sortWithinPartitions("tree", "block", "index").mapInArrow(
            lambda batches: _up_task(batches, block_levels), _UP), "tops")
        done = tops.filter("count = 1")
        rounds.append((nodes, done))
        roots = done if roots is None else roots.union(done)
        nodes = tops.filter("count > 1")
        if nodes.isEmpty():
            return rounds, roots.select("tree", "digest")


def _block(block_levels: int) -> Column:
    return F.expr(f"index div {FAN**block_levels}").alias("block")


def _deliver(nodes: DataFrame, heads: DataFrame, block_levels: int, more: list[str]) -> DataFrame:
    """Nodes and the heads of their blocks, by block, each head before its nodes."""
    body = nodes.select("tree", _block(block_levels), "index", "count", "digest", *more)
    top = heads.select("tree", F.col("index").alias("block"), F.lit(-1).cast("long").alias("index"), "path", "subroot", "root")
    return (top.unionByName(body, allowMissingColumns=True)
            .repartition("tree", "block").sortWithinPartitions("tree", "block", "index"))


def _descend(rounds: list[tuple[DataFrame, DataFrame]], heads: DataFrame, block_levels: int) -> DataFrame:
    """The heads of the lowest blocks, from ``heads`` (one per tree)."""
    coming = None
    for number in range(len(rounds) - 1, -1, -1):
        nodes, done = rounds[number]
        ending = heads.join(done.select("tree"), "tree").select(*heads.columns)
        coming = ending if coming is None else coming.unionByName(ending)
        if number:
            body = _deliver(nodes.withColumn("name", F.lit(None).cast("string")), coming, block_levels, ["name"])
            coming = settle(body.mapInArrow(lambda batches: _down_task(batches, block_levels), _DOWN), "heads")
    return coming


def leaf_digest(text: Column | None = None) -> Column:
    """SHA-256 of a document's fields, each as ``-`` or its UTF-8 length, a colon and its value."""
    def part(name: str) -> Column:
        value = text if name == "text" and text is not None else F.col(name).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*[part(name) for name in FIELDS]), 256))


def merkle_manifest(docs: DataFrame, found_text: Column | None = None, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, proof.

    ``found_text`` is the text to hold against the manifest (the document's own by
    default): its leaf is folded with the siblings of ``proof`` to ``folded_root``,
    and ``verified`` says whether that is the root. ``proof`` holds the siblings
    from the leaf to the root (``steps`` reads it).

    A null field counts as such and differs from an empty one; a null source is a
    source of its own, ahead of the others; null ids come first within a source.
    Leaves of one id are ordered by digest, so repeated rows get equal leaves and
    one place each. An empty table has no rows and no root. Other columns are
    ignored, whatever their names.
    """
    require_columns(docs, FIELDS)
    ship_package(docs.sparkSession)
    rows = docs.select(
        # Ordered as the sources are: null first, then bytewise.
        F.coalesce(F.concat(F.lit("1"), F.col("source")), F.lit("0")).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"), leaf_digest().alias("digest"), leaf_digest(found_text).alias("altered"))
    leaves = settle(ranked(rows, ["tree"], [F.col("doc_id").asc_nulls_first(), F.col("digest").asc()]).select(
        "tree", F.col("size").alias("count"), F.col("rank").alias("index"), "digest", "doc_id", "altered"), "leaves")
    rounds, subroots = _climb(leaves, block_levels)

    sources = settle(ranked(subroots, [], [F.col("tree").asc()]).select(
        F.lit("").alias("tree"), F.col("size").alias("count"), F.col("rank").alias("index"), "digest",
        F.col("tree").alias("name")), "sources")
    upper, root = _climb(sources, block_levels)
    nothing = F.lit(b"").cast("binary")
    heads = root.select("tree", F.lit(0).cast("long").alias("index"), nothing.alias("path"), nothing.alias("subroot"),
                        F.col("digest").alias("root"))
    of_sources = settle(_deliver(upper[0][0], _descend(upper, heads, block_levels), block_levels, ["name"]).mapInArrow(
        lambda batches: _down_task(batches, block_levels), _DOWN), "heads")
    body = _deliver(leaves, _descend(rounds, of_sources, block_levels), block_levels, ["doc_id", "altered"])
    return body.mapInArrow(lambda batches: _leaf_task(batches, block_levels), _LEAVES)
