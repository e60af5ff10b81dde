"""SimHash near-duplicates by a segment-popcount embedding and a grid join.

A 64-bit fingerprint has 32 segments of two bits. Its embedding is the number
of set bits of each segment (0 to 2), a point in 32 dimensions. Changing a bit
changes one coordinate by one, so the Manhattan distance of two points is at
most the number of differing bits: a lower bound.

**Grid join.** The coordinates form eight groups of four. If at most ``d`` bits
differ, at most ``d`` coordinates do, hence at least ``8 - d`` groups agree
exactly. Every point goes into one cell per choice of ``8 - d`` groups (70 for
d = 4); points within the distance share a cell. Within a cell, pairs that pass
the Manhattan bound are verified on the fingerprints themselves.

**No pairs are sent.** Only links matter: a task reads its cells in order and
keeps a forest of them. Cells of a few points are compared by shifting the sorted rows against
each other. In larger ones the points next to a pivot are taken out as one
set, again and again until each has been a pivot or has been reached, as in a
breadth-first search: a group of thousands of near copies costs a few passes
over the cell, and one link per point. Pieces of the forest meet in connected
components. Equal fingerprints count once, so exact copies cost nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomledger.llm.common import WHITE, own_columns, require_columns, settle, ship_package, whole_text
from loomledger.llm.components import connected_components

SHINGLE = 4
MAX_DISTANCE = 4
SEED = 42
GROUPS = 8
#: Cells of at most so many points are compared pair by pair.
SMALL_CELL = 24
_LOW_BITS = 0x5555555555555555


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The SimHash of a text's word shingles, repeats included; 0 without words."""
    import xxhash

    # Upper-case ASCII letters become small ones, others stay.
    words = text.encode().lower().translate(_TO_SPACE).split(b" ")
    words = [word for word in words if word]
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words])
    starts = [0, *ends[:-1].tolist()]
    width = min(shingle, len(words))
    stops = (ends[width - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], seed) for a, b in zip(starts, stops, strict=False)], dtype=">u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
    over = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int.from_bytes(np.packbits(over).tobytes(), "big")


_TO_SPACE = bytes(32 if chr(b) in WHITE else b for b in range(256))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE, seed: int = SEED, hashed: bool = False) -> DataFrame:
    """(doc_id, fp) per row, fp as a signed long; with ``hashed`` also text_hash."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            values = [_signed(fingerprint(text.as_py(), shingle, seed)) for text in texts]
            columns = [batch.column("doc_id"), pa.array(values, pa.int64()), *[batch.column(name) for name in more]]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "fp", *more])

    more = ["text_hash"] if hashed else []
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"),
                       *[F.xxhash64(whole_text(text_col)).alias(name) for name in more])
    return rows.mapInArrow(run, ", ".join(["doc_id long", "fp long", *[f"{name} long" for name in more]]))


def embed(fp: np.ndarray) -> np.ndarray:
    """Segment popcounts in unary, two bits per segment: 0 as 00, 1 as 01, 2 as 11."""
    low, high = fp & np.uint64(_LOW_BITS), (fp >> np.uint64(1)) & np.uint64(_LOW_BITS)
    return (low | high) | ((low & high) << np.uint64(1))


def cell_masks(max_distance: int) -> list[int]:
    """Bits of the embedding that make up a cell, per choice of groups."""
    if not 0 <= max_distance < GROUPS:
        raise ValueError(f"max_distance must be from 0 to {GROUPS - 1}")
    byte = 64 // GROUPS
    return [sum(((1 << byte) - 1) << (byte * g) for g in chosen) for chosen in combinations(range(GROUPS), GROUPS - max_distance)]


def _near(fp: np.ndarray, at: np.ndarray, other: np.ndarray, distance: int) -> np.ndarray:
    """Whether fp[at] and fp[other] are linked: bounded by Manhattan distance, then exact."""
    near = np.bitwise_count(embed(fp[at]) ^ embed(fp[other])) <= distance
    some = np.flatnonzero(near)
    near[some] = np.bitwise_count(fp[at[some]] ^ fp[other[some]]) <= distance
    return near


def links_of_cells(keys: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest of links within runs of equal keys."""
    edges = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
    low, size = edges[:-1], np.diff(edges)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    ends = np.repeat(edges[1:], size)
    few = np.repeat(size <= SMALL_CELL, size)
    at = np.flatnonzero(few & (np.repeat(size, size) > 1))
    for shift in range(1, SMALL_CELL):
        at = at[at + shift < ends[at]]
        if not len(at):
            break
        near = _near(fp, at, at + shift, distance)
        found.append((at[near], at[near] + shift))
    for begin, count in zip(low[size > SMALL_CELL].tolist(), size[size > SMALL_CELL].tolist(), strict=True):
        left = np.arange(begin, begin + count)
        frontier: list[int] = []
        while len(left):
            if not frontier:
                frontier, left = [int(left[0])], left[1:]
            pivot = frontier.pop()
            near = _near(fp, left, np.full(len(left), pivot), distance)
            reached = left[near]
            found.append((np.full(len(reached), pivot), reached))
            frontier += reached.tolist()
            left = left[~near]
    if not found:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def near_links(points: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Links (a, b) between distinct fingerprints of column ``fp`` that connect all within the distance."""
    ship_package(points.sparkSession)
    # The embedding, as SQL: unary popcounts of two-bit segments.
    low = F.col("fp").bitwiseAND(F.lit(_LOW_BITS))
    high = F.shiftrightunsigned("fp", 1).bitwiseAND(F.lit(_LOW_BITS))
    vector = low.bitwiseOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))
    masks = F.array(*[F.lit(_signed(mask)) for mask in cell_masks(max_distance)])
    cells = (points.select("fp", vector.alias("vector")).select("fp", "vector", F.posexplode(masks).alias("choice", "mask"))
             .select("fp", F.xxhash64("choice", F.col("vector").bitwiseAND(F.col("mask"))).alias("cell")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_keys, held = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)

        def links(keys: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            a, b = links_of_cells(keys, fp, max_distance)
            return pa.RecordBatch.from_arrays([pa.array(fp[a].view(np.int64)), pa.array(fp[b].view(np.int64))], ["a", "b"])

        for batch in batches:
            keys = np.concatenate([held_keys, batch.column("cell").to_numpy(zero_copy_only=False)])
            fp = np.concatenate([held, batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)])
            if not len(keys):
                continue
            cut = int(np.searchsorted(keys, keys[-1]))  # the last cell may go on in the next batch
            if cut:
                yield links(keys[:cut], fp[:cut])
            held_keys, held = keys[cut:], fp[cut:]
        if len(held_keys):
            yield links(held_keys, held)

    return (cells.repartition("cell").sortWithinPartitions("cell", "fp")
            .mapInArrow(run, "a long, b long"))


def _placed(points: DataFrame, max_distance: int) -> DataFrame:
    """``points`` with the component of each fingerprint."""
    roots = connected_components(near_links(points, max_distance)).withColumnRenamed("node", "fp")
    return points.join(roots, "fp", "left").withColumn("component", F.coalesce("component", "fp"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                       max_distance: int = MAX_DISTANCE, seed: int = SEED) -> DataFrame:
    """One row per input row: doc_id, fp (signed long), component_id.

    ``component_id`` is the smallest id that links of at most ``max_distance``
    differing bits reach. Null text counts as empty, texts without words have
    fingerprint 0 and are linked like any other. Rows without an id take part;
    a component of such rows alone has a null id. Rows that repeat an id are
    separate. Other columns are ignored; an empty table gives an empty result.
    """
    require_columns(docs, [id_col, text_col])
    rows = settle(fingerprints(docs, id_col, text_col, shingle, seed), "fingerprints")
    points = settle(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "points")
    placed = _placed(points, max_distance)
    named = placed.groupBy("component").agg(F.min("least_id").alias("component_id"))
    classes = placed.select("fp", "component").join(named, "component").select("fp", "component_id")
    return rows.join(classes, "fp").select("doc_id", "fp", "component_id")


def keep_one_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                  max_distance: int = MAX_DISTANCE, without_id: bool = False) -> DataFrame:
    """One row of every near-duplicate component: that of the smallest id, then of the smallest hash of its text.

    Rows without an id come last. With ``without_id`` a component of such rows
    alone keeps one of them too, else none. Different texts that bear one id
    stay, each in its own component.
    """
    docs = own_columns(docs, ["_place", "_hash", "_kept_id", "_kept_hash"], [id_col, text_col])
    rows = settle(fingerprints(docs, id_col, text_col, shingle, hashed=True), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("first")
    points = settle(rows.groupBy("fp").agg(first), "points")
    kept = (_placed(points, max_distance).groupBy("component").agg(F.min("first").alias("first"))
            .select(F.col("first.doc_id").alias("_kept_id"), F.col("first.text_hash").alias("_kept_hash")))
    if not without_id:
        kept = kept.filter(F.col("_kept_id").isNotNull())
    chosen = F.col(id_col).cast("long").eqNullSafe(F.col("_kept_id")) & (F.col("_hash") == F.col("_kept_hash"))
    # Rows that repeat both id and text are one document.
    order = Window.partitionBy(id_col, "_hash").orderBy("_hash")
    return (docs.withColumn("_hash", F.xxhash64(whole_text(text_col))).join(kept, chosen, "left_semi")
            .withColumn("_place", F.row_number().over(order)).filter("_place = 1").drop("_place", "_hash"))
