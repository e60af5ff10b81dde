"""Document fingerprints by winnowing, and the likeness of edited and neighbouring documents.

A rolling hash runs over every ``GRAM`` code points of a text. Of every ``WINDOW``
successive hashes the smallest is kept, of equal ones the rightmost, with its
position. So two texts that share a passage of ``GRAM + WINDOW - 1`` code points
share at least one kept hash inside it, at positions that differ as the passage's
do, and no passage of under ``GRAM`` code points makes them alike. A text of fewer
grams has one window; one shorter than a gram is a single gram; an empty one has
none.

Neighbours in the order of ids are paired without a global sort: ranges of ids of
about ``RANGE_BYTES`` of text become blocks, each block also receives the first
document of the block that follows, and within a block documents stream past in
order, one at a time. Rows without an id follow in ranges of their texts' hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomledger.llm.common import require_columns, ship_package, whole_text

GRAM = 16
WINDOW = 64
RANGE_BYTES = 32 << 20
#: Quantiles of ids; each cell between two is split further where there are more ranges than cells.
CELLS = 64
_BASE = 0x9E3779B97F4A7C15
_HASH_BITS = 48


# --- one text ---------------------------------------------------------------------


def gram_hashes(codes: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """The hash of every ``gram`` successive code points; one hash of all where there are fewer."""
    gram = min(gram, len(codes))
    if not gram:
        return np.zeros(0, dtype=np.uint64)
    power, width = codes.astype(np.uint64) + np.uint64(1), 1
    power *= np.uint64(0xD6E8FEB86659FD93)
    power ^= power >> np.uint64(32)
    out, covered = None, 0
    count = len(codes) - gram + 1
    # Polynomials of 1, 2, 4, ... code points, joined by the binary digits of the gram's length.
    while True:
        if gram & width:
            part = power[covered:covered + count]
            out = part if out is None else out * np.uint64(pow(_BASE, width, 1 << 64)) + part
            covered += width
        if covered == gram:
            break
        power = power[:-width] * np.uint64(pow(_BASE, width, 1 << 64)) + power[width:]
        width *= 2
    out = out ^ (out >> np.uint64(29))
    out = out * np.uint64(0xBF58476D1CE4E5B9)
    return (out ^ (out >> np.uint64(32))) >> np.uint64(64 - _HASH_BITS)


def winnow(text: str, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) of the fingerprints of ``text``, in the order of positions."""
    hashes = gram_hashes(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32), gram)
    if not len(hashes):
        return hashes, np.zeros(0, dtype=np.int64)
    window = min(window, len(hashes))
    least, width = np.arange(len(hashes)), 1
    while width * 2 <= window:
        least = _rightmost_least(hashes, least[:-width], least[width:])
        width *= 2
    rest = window - width  # two overlapping spans make up the window
    if rest:
        least = _rightmost_least(hashes, least[:-rest], least[rest:])
    positions = least[np.concatenate([[True], least[1:] != least[:-1]])]
    return hashes[positions], positions


def _rightmost_least(hashes: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.where(hashes[left] < hashes[right], left, right)


def written(hashes: np.ndarray, positions: np.ndarray) -> str:
    """A fingerprint as text: hash and position of each kept gram in hexadecimal digits."""
    return " ".join(f"{h:012x}@{p:x}" for h, p in zip(hashes.tolist(), positions.tolist(), strict=True))


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    """Shared hashes over all hashes of both; two empty fingerprints are alike."""
    one, other = np.unique(one), np.unique(other)
    if not len(one) and not len(other):
        return 1.0
    shared = len(np.intersect1d(one, other, assume_unique=True))
    return shared / (len(one) + len(other) - shared)


def edited_text(text: str, following: str) -> str:
    """``text`` with its last third replaced by the beginning of ``following``."""
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


# --- the table --------------------------------------------------------------------


def _fingerprint_task(batches: Iterator[pa.RecordBatch], gram: int, window: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("fingerprint", pa.string()), ("n_fingerprints", pa.int64())])
    for batch in batches:
        found = [winnow(text, gram, window) for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array([written(*f) for f in found], pa.string()),
            pa.array([len(f[0]) for f in found], pa.int64())], schema=schema)


def fingerprints(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """doc_id, fingerprint (see ``written``) and n_fingerprints of every document; a null text is empty."""
    require_columns(docs, ["doc_id", "text"])
    ship_package(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).mapInArrow(
        lambda batches: _fingerprint_task(batches, gram, window),
        "doc_id long, fingerprint string, n_fingerprints long")


def _block_of(column: Column, cuts: list[int], split: int) -> Column:
    """The number of a value's block, counted from the largest values down.

    ``cuts`` (ascending, the smallest and the largest value among them) bound cells, which
    a binary search finds; each cell is split into ``split`` blocks of equal width.
    """
    cells = len(cuts) - 1
    if cells < 1:
        return F.lit(0).cast("long")

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(column <= F.lit(cuts[middle + 1]), search(low, middle)).otherwise(search(middle + 1, high))

    cell = search(0, cells - 1)
    top = F.get(F.array(*[F.lit(float(c)) for c in cuts[1:]]), cell)
    width = F.get(F.array(*[F.lit(max(1.0, (float(b) - float(a)) / split)) for a, b in pairwise(cuts)]), cell)
    part = F.floor((top - column.cast("double")) / width).cast("long")
    return (F.lit(cells - 1) - cell) * split + F.least(F.greatest(part, F.lit(0)), F.lit(split - 1))


def _in_blocks(docs: DataFrame, range_bytes: int) -> tuple[DataFrame, int]:
    """Rows (block, borrowed, doc_id, tie, text), every block with the first document of the next one, and the number of blocks.

    Blocks are numbered in the order in which documents follow each other, descending.
    Few numbers reach the driver: sizes and at most ``CELLS`` quantiles.
    """
    text = whole_text()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.shiftright(F.xxhash64(text), 16).alias("tie"), text.alias("text"))
    unnamed = F.when(F.col("doc_id").isNull(), F.col("tie"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("bytes"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"),
                    F.min(unnamed).alias("tie_low"), F.max(unnamed).alias("tie_high")).first()
    ranges = max(1, (size["bytes"] or 0) // range_bytes)
    cells = min(CELLS, ranges)
    parts = [at / cells for at in range(1, cells)]

    def cuts(name: str, which: str, low: int | None, high: int | None) -> list[int]:
        if low is None:
            return []
        inner = rows.filter(which).agg(F.percentile_approx(name, parts, 10 * CELLS)).first()[0] if parts else []
        return sorted({low - 1, high, *[c for c in inner or [] if low <= c <= high]})

    split = -(-ranges // cells)
    named_cuts = cuts("doc_id", "doc_id is not null", size["low"], size["high"])
    tie_cuts = cuts("tie", "doc_id is null", size["tie_low"], size["tie_high"])
    named = max(0, len(named_cuts) - 1) * split
    rows = rows.withColumn("block", F.when(F.col("doc_id").isNotNull(), _block_of(F.col("doc_id"), named_cuts, split))
                           .otherwise(F.lit(named) + _block_of(F.col("tie"), tie_cuts, split)))
    # One entry per block, some ``range_bytes`` of text each: few enough to be sent to all tasks.
    firsts = rows.groupBy("block").agg(F.max("doc_id").alias("_id"), F.max(unnamed).alias("_tie"))
    lender = F.coalesce(F.lag("block").over(Window.orderBy("block")), F.max("block").over(Window.partitionBy()))
    heads = firsts.select(F.col("block").alias("_block"), "_id", "_tie", lender.alias("_to"))
    first = (F.col("block") == F.col("_block")) & F.when(F.col("doc_id").isNull(), F.col("tie") == F.col("_tie")).otherwise(
        F.col("doc_id") == F.col("_id"))
    borrowed = rows.join(F.broadcast(heads), first).select(
        F.col("_to").alias("block"), F.lit(True).alias("borrowed"), "doc_id", "tie", "text")
    blocks = max(1, named + max(0, len(tie_cuts) - 1) * split)
    return rows.select("block", F.lit(False).alias("borrowed"), "doc_id", "tie", "text").union(borrowed), blocks


_PAIRS = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def _pair_task(batches: Iterator[pa.RecordBatch], gram: int, window: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                        ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()),
                        ("near_next", pa.float64())])

    def pairs() -> Iterator[tuple]:
        held = None
        for batch in batches:
            columns = [batch.column(name) for name in ("block", "borrowed", "doc_id", "text")]
            for at in range(batch.num_rows):
                block, borrowed, doc_id, text = (column[at].as_py() for column in columns)
                if held is not None and held[0] != block:
                    held = None
                if held is None and borrowed:
                    continue  # further copies of the borrowed document
                prints = winnow(text, gram, window)
                if held is not None:
                    _, last_id, last_text, last = held
                    edited = edited_text(last_text, text)
                    changed = winnow(edited, gram, window)
                    yield (last_id, len(last_text), sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                           written(*last), written(*changed), likeness(last[0], changed[0]), likeness(last[0], prints[0]))
                held = None if borrowed else (block, doc_id, text, prints)

    waiting: list[tuple] = []
    for row in pairs():
        waiting.append(row)
        if len(waiting) >= 256:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*waiting), schema)], schema=schema)
            waiting = []
    if waiting:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*waiting), schema)], schema=schema)


def edit_likeness(docs: DataFrame, gram: int = GRAM, window: int = WINDOW, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Per document its fingerprint and that of its edited text, and how like its own the edited and the next one's are.

    The next document is the one of the next smaller id, after the smallest the
    first again; a document alone is its own next. The edited text is
    ``edited_text`` of the document and the next. Likeness is shared over all
    hashes (``likeness``).

    A null text is empty. Rows of one id follow each other by descending hash of
    their texts, rows that repeat both are neighbours, rows without an id come
    last. An empty table has no rows; other columns are ignored, whatever their
    names. Texts are taken whole, a very long one is one row in one task.
    """
    require_columns(docs, ["doc_id", "text"])
    ship_package(docs.sparkSession)
    rows, blocks = _in_blocks(docs, range_bytes)
    order = [F.col("block"), F.col("borrowed"), F.col("doc_id").desc_nulls_last(), F.col("tie").desc(), F.col("text")]
    # A task per block: a hash would put several together.
    return rows.repartitionById(blocks, F.col("block").cast("int")).sortWithinPartitions(*order).select("block", "borrowed", "doc_id", "text").mapInArrow(
        lambda batches: _pair_task(batches, gram, window), _PAIRS)
