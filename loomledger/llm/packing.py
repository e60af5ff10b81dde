"""Harmonic packing of tokenised documents into sequences of fixed capacity.

Lengths fall into classes by reciprocal capacity: class ``k`` holds lengths up
to ``capacity / k``, and a bin of class ``k`` takes exactly ``k`` of them.
Documents may be cut, so each is cut where the classes waste nothing: into
pieces of ``capacity / k`` ids with ``k`` a power of two, the longest first.
Every class fills its own bins, in every partition by itself, so packing takes
no shuffle and no worker waits for another. A full bin is a sequence of exactly
``capacity`` ids; the bins still open at the end of a partition (at most one per
class) are divided into sequences whose lengths are powers of two. As such
sequences need no padding, nothing is padded at all.

The pieces of open bins are all that a task holds: fewer than ``2 * capacity``.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomledger.llm.common import require_columns, ship_package, whole_text
from loomledger.llm.tokenizers_io import vocabulary_path
from loomledger.llm.word_ids import word_encoder

CAPACITY = 2048
END_ID = 1
#: Sequences of one partition are numbered from its number times two to this power.
SEQUENCE_BITS = 40
#: Rows of a batch that are text in Python at once: a worker's memory.
SLICE = 256
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "sequence_length long")


def cut_lengths(tokens: int, capacity: int) -> list[int]:
    """Whole sequences, then falling powers of two."""
    rest = tokens % capacity
    return [capacity] * (tokens // capacity) + [1 << bit for bit in range(capacity.bit_length() - 1, -1, -1) if rest >> bit & 1]


class HarmonicBins:
    """The open bin of each class, and the number of the next sequence."""

    def __init__(self, capacity: int, first_sequence: int) -> None:
        self.capacity = capacity
        self.next_sequence = first_sequence
        self.open: dict[int, list[tuple]] = {}

    def add(self, length: int, piece: tuple) -> list[tuple]:
        """The rows of the bin that this piece fills, else nothing."""
        per_bin = self.capacity // length
        bin_ = self.open.setdefault(length, [])
        bin_.append(piece)
        if len(bin_) < per_bin:
            return []
        return self._sequence(self.open.pop(length), length)

    def _sequence(self, pieces: list[tuple], length: int) -> list[tuple]:
        rows = [(*piece, self.next_sequence, i * length, len(pieces) * length) for i, piece in enumerate(pieces)]
        self.next_sequence += 1
        return rows

    def close(self) -> list[tuple]:
        rows: list[tuple] = []
        for length, pieces in sorted(self.open.items()):
            while pieces:
                take = 1 << (len(pieces).bit_length() - 1)
                rows += self._sequence(pieces[:take], length)
                pieces = pieces[take:]
        self.open = {}
        return rows


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                   vocabulary: str | None = None, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_length.

    A document's ids are those of the vocabulary's library without added
    special tokens, then ``end_id``; null text is empty, so every row has one id
    at least. Each row is cut on its own, also where ids repeat or are null.
    ``start`` counts the document's ids before the piece, ``ids_crc32`` is over
    its ids as little-endian unsigned 32-bit numbers. Other columns are
    ignored; an empty table gives an empty result.
    """
    require_columns(docs, [id_col, text_col])
    ship_package(docs.sparkSession)
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    path = vocabulary_path("word_bpe_49k.json", vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(path)
        bins = HarmonicBins(capacity, TaskContext.get().partitionId() << SEQUENCE_BITS)
        names = [field.split()[0] for field in SCHEMA.split(", ")]

        def emit(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in zip(*rows, strict=True)], names)

        for batch in batches:
            for low in range(0, batch.num_rows, SLICE):
                part = batch.slice(low, SLICE)
                rows: list[tuple] = []
                ids = part.column("doc_id").to_pylist()
                for doc_id, tokens in zip(ids, encoder.encode(part.column("text").to_pylist()), strict=True):
                    raw = np.append(tokens, end_id).astype("<u4").tobytes()
                    total, start = len(raw) // 4, 0
                    for length in cut_lengths(total, capacity):
                        piece = (doc_id, start, length, crc32(raw[4 * start:4 * (start + length)]), total)
                        rows += bins.add(length, piece)
                        start += length
                if rows:
                    yield emit(rows)
        if rows := bins.close():
            yield emit(rows)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text")).mapInArrow(run, SCHEMA)
