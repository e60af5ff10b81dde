"""Line deduplication by winnowing: window minima, joined positions, matches extended both ways.

A document is the sequence of its words, whatever lines they stand in, so a line
meets its copy inside a longer line and short lines meet long ones. A shingle is
``min_words`` words in a row; its hash is made from the words alone.

1. Of every ``WINDOW`` shingles in a row the one of smallest hash (by its upper 32
   bits; the last, on ties) is a fingerprint, and so is the shingle at the start of every line. Two equal
   runs of ``min_words + WINDOW - 1`` words therefore share a fingerprint at the
   same place, as do equal lines of ``min_words`` words or more.
2. Hashes are counted, pre-aggregated by each task; fingerprints that occur once are
   dropped before anything but a hash and a position has moved.
3. Every other position is joined to the first occurrence of its fingerprint (by
   id, text hash, then word), never to one another. An occurrence that is the first or
   overlaps the first is left alone.
4. The first occurrence's ``WINDOW - 1`` words on either side are fetched from its
   document. A later match is extended over them, both ways, as long as
   the words agree; beyond that reach stands another fingerprint.
5. The union of a document's matches is deleted.

So every word that goes stands in a run of at least ``min_words`` words that occurs
earlier. Words left of a repeated passage of ``min_words + WINDOW - 1`` words or more are
at its ends only, where a fingerprint's first occurrence is in another context. Repeats of
fewer words are found where they start a line or hold a window's minimum.

Shingles are compared by 64-bit hashes, words beside them by 32-bit ones. Hashes are
polynomials modulo 2**64 from which those of any run follow by prefix sums.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomledger.llm.common import own_columns, require_columns, settle, ship_package, whole_text

MIN_WORDS = 10
WINDOW = 19
#: Bytes of text hashed at once; a longer text is taken alone.
SLICE_BYTES = 500_000
_DOCUMENT = ["doc_id", "doc_hash"]
_BLANK = b" \t\x0b\x0c\r"
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[32, *range(9, 14)]] = True
_POWERS: dict[int, np.ndarray] = {}
_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95


@dataclass
class Words:
    """The words of some texts: byte spans, the first word of each text, which words open a line, hashes."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    opens_line: np.ndarray
    hashes: np.ndarray


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _powers(base: int, count: int) -> np.ndarray:
    """1, base, base squared and so on, kept by the worker for texts of usual size."""
    known = _POWERS.get(base)
    if known is None or len(known) < count:
        powers = np.full(max(count, SLICE_BYTES + 1), base, dtype=np.uint64)
        powers[0] = 1
        known = np.cumprod(powers, dtype=np.uint64)
        if count <= SLICE_BYTES + 1:
            _POWERS[base] = known
    return known[:count]


def _run_hashes(values: np.ndarray, base: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of every run ``values[start:end]``, the same wherever the run stands."""
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * _powers(base, len(values)), out=sums[1:])
    return _mixed((sums[ends] - sums[starts]) * _powers(pow(base, -1, 2**64), len(values))[starts])


def read_words(texts: pa.Array) -> Words:
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    inside = ~_WHITE[data]
    bound = np.zeros(len(data) + 1, dtype=bool)
    bound[offsets] = True
    outside_before = np.ones(len(data), dtype=bool)
    outside_before[1:] = ~inside[:-1]
    outside_after = np.ones(len(data), dtype=bool)
    outside_after[:-1] = ~inside[1:]
    starts = np.flatnonzero(inside & (outside_before | bound[:-1]))
    ends = np.flatnonzero(inside & (outside_after | bound[1:])) + 1
    first = np.searchsorted(starts, offsets)
    opens_line = np.zeros(len(starts) + 1, dtype=bool)
    opens_line[np.searchsorted(starts, np.flatnonzero(data == 10))] = True
    opens_line[first[:-1]] = True
    opens_line = opens_line[:-1]
    hashes = _run_hashes(data.astype(np.uint64) + np.uint64(1), _BYTE_BASE, starts, ends)
    return Words(data, offsets, starts, ends, first, opens_line, hashes)


def fingerprints(words: Words, min_words: int = MIN_WORDS, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text, first word in the text) of every fingerprint."""
    count = len(words.hashes) - min_words + 1
    if count < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
    at = np.arange(count)
    shingles = _run_hashes(words.hashes, _WORD_BASE, at, at + min_words)
    text_end = np.repeat(words.first[1:], np.diff(words.first))[:count]
    whole = at + min_words <= text_end
    chosen = words.opens_line[:count] & whole
    # Upper half of the hash, then the place from the right: the least key is the last of the smallest hashes.
    least, reach = (shingles & np.uint64(0xFFFFFFFF00000000)) | (np.uint64(0xFFFFFFFF) - at.astype(np.uint64)), 1
    while reach < window and len(least):
        # The least of a longer stretch is the least of two shorter ones that cover it.
        step = min(reach, window - reach)
        least, reach = np.minimum(least[:-step], least[step:]), reach + step
    full = at[:len(least)] + (window - 1 + min_words) <= text_end[:len(least)]
    chosen[(np.uint64(0xFFFFFFFF) - (least[full] & np.uint64(0xFFFFFFFF))).astype(np.int64)] = True
    found = np.flatnonzero(chosen)
    text = np.searchsorted(words.first[1:], found, side="right")
    return shingles[found].view(np.int64), text, (found - words.first[text]).astype(np.int32)


def _slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``SLICE_BYTES`` of text, or with one text."""
    sizes = np.array([0 if size is None else size for size in pc.binary_length(batch.column(column)).to_pylist()], dtype=np.int64)
    low, total = 0, 0
    for high, size in enumerate(sizes.tolist()):
        if high > low and total + size > SLICE_BYTES:
            yield batch.slice(low, high - low)
            low, total = high, 0
        total += size
    if low < len(sizes):
        yield batch.slice(low)


def document_key(id_col: str, text_col: str) -> tuple[Column, Column]:
    """(doc_id, doc_hash) without nulls: rows without an id come first and differ in the hash."""
    number = F.col(id_col).cast("long")
    return F.coalesce(number, F.lit(-2**63)), F.xxhash64(whole_text(text_col), number.isNull())


def positions(docs: DataFrame, id_col: str, text_col: str, min_words: int, placed: bool) -> DataFrame:
    """A row per fingerprint: its hash and, if ``placed``, its document and first word."""
    ship_package(docs.sparkSession)
    schema = "fp long, doc_id long, doc_hash long, at int" if placed else "fp long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, "text"):
                found, text, at = fingerprints(read_words(part.column("text")), min_words)
                if placed:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found), part.column("doc_id").take(pa.array(text)), part.column("doc_hash").take(pa.array(text)), pa.array(at)],
                        ["fp", "doc_id", "doc_hash", "at"])
                else:
                    yield pa.RecordBatch.from_arrays([pa.array(found)], ["fp"])

    own = [column.alias(name) for column, name in zip(document_key(id_col, text_col), _DOCUMENT, strict=True)] if placed else []
    return docs.select(*own, whole_text(text_col).alias("text")).mapInArrow(run, schema)


def _with_lists(docs: DataFrame, lists: DataFrame) -> DataFrame:
    """Keyed documents beside the list of their document, or null."""
    lists = lists.withColumnsRenamed({"doc_id": "_list_id", "doc_hash": "_list_hash"})
    match = (F.col("_doc_id") == F.col("_list_id")) & (F.col("_doc_hash") == F.col("_list_hash"))
    return docs.join(lists, match, "left").drop("_list_id", "_list_hash")


def surroundings(docs: DataFrame, origins: DataFrame, text_col: str, min_words: int) -> DataFrame:
    """(fp, first_id, first_hash, first_at, before, after): the words around each first occurrence, as 32-bit hashes.

    ``docs`` are keyed; all their columns pass, so that their shuffle is the one of the deletion.
    """
    lists = origins.groupBy(*_DOCUMENT).agg(F.collect_list(F.struct("fp", "at")).alias("_places"))
    fields = ["fp", "first_id", "first_hash", "first_at", "before", "after"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column("_places").is_valid())
            for part in _slices(batch, text_col):
                words = read_words(part.column(text_col))
                short = words.hashes.astype(np.uint32)
                rows = []
                for i, places in enumerate(part.column("_places").to_pylist()):
                    low, high = int(words.first[i]), int(words.first[i + 1])
                    own = part.column("_doc_id")[i].as_py(), part.column("_doc_hash")[i].as_py()
                    for place in places:
                        a = low + place["at"]
                        b = a + min_words
                        rows.append((place["fp"], *own, place["at"], short[max(low, a - WINDOW + 1):a].tobytes(), short[b:min(high, b + WINDOW - 1)].tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)] if rows
                                                 else [pa.array([], t) for t in types], fields)

    around = _with_lists(docs, lists).mapInArrow(run, "fp long, first_id long, first_hash long, first_at int, before binary, after binary")
    # Rows that repeat id and text are one document and give the same words.
    return around.groupBy("fp").agg(F.any_value(F.struct(*fields[1:])).alias("o")).select("fp", "o.*")


def later_matches(docs: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """(doc_id, doc_hash, matches): the fingerprints of each document that occur earlier, with the words around the first."""
    plain = docs.drop("_doc_id", "_doc_hash")
    repeated = positions(plain, id_col, text_col, min_words, placed=False).groupBy("fp").count().filter("count > 1").select("fp")
    places = settle(positions(plain, id_col, text_col, min_words, placed=True).join(repeated, "fp"), "repeated-fingerprints")
    origins = (places.groupBy("fp").agg(F.min(F.struct(*_DOCUMENT, "at")).alias("first"))
               .select("fp", "first.*"))
    around = surroundings(docs, origins, text_col, min_words)
    same = (F.col("doc_id") == F.col("first_id")) & (F.col("doc_hash") == F.col("first_hash"))
    # Within one document a match is not extended into its own first occurrence.
    room = F.when(same, F.col("at") - F.col("first_at") - F.lit(min_words)).otherwise(F.lit(WINDOW - 1)).cast("int")
    return (places.join(around, "fp").withColumn("room", room).filter("room >= 0")
            .groupBy(*_DOCUMENT).agg(F.collect_list(F.struct("at", "room", "before", "after")).alias("_matches")))


def _hash_lists(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The 32-bit hashes of all lists, and where each list starts and ends."""
    bounds = np.frombuffer(lists.buffers()[1], np.int32)[lists.offset:lists.offset + len(lists) + 1] // 4
    values = np.frombuffer(lists.buffers()[2] or b"", np.uint8)
    return values[:len(values) // 4 * 4].view(np.uint32), bounds[:-1], bounds[1:]


def _agreeing(own: np.ndarray, own_at: np.ndarray, other: np.ndarray, other_at: np.ndarray, most: np.ndarray, way: int) -> np.ndarray:
    """How many words in a row agree, from the given places on and ``most`` at most, forwards or backwards."""
    agree = np.zeros(len(own_at), dtype=np.int64)
    active = np.flatnonzero(most > 0)
    for step in range(WINDOW - 1):
        active = active[own[own_at[active] + way * step] == other[other_at[active] + way * step]]
        agree[active] = step + 1
        active = active[most[active] > step + 1]
    return agree


def repeated_words(words: Words, found: pa.ListArray, min_words: int) -> np.ndarray:
    """Which words stand in a match of their text, extended both ways."""
    short = words.hashes.astype(np.uint32)
    matches = found.flatten()
    text = np.repeat(np.arange(len(found)), pc.fill_null(pc.list_value_length(found), 0).to_numpy())
    at, room = (matches.field(name).to_numpy().astype(np.int64) for name in ("at", "room"))
    low = words.first[text] + at
    high = low + min_words
    before, begin, end = _hash_lists(matches.field("before"))
    left = _agreeing(short, low - 1, before, end.astype(np.int64) - 1, np.minimum(np.minimum(room, at), end - begin), -1)
    after, begin, end = _hash_lists(matches.field("after"))
    right = _agreeing(short, high, after, begin.astype(np.int64), np.minimum(np.minimum(room, words.first[text + 1] - high), end - begin), 1)
    edge = np.bincount(low - left, minlength=len(short) + 1) - np.bincount(high + right, minlength=len(short) + 1)
    return np.cumsum(edge)[:-1] > 0


def without_words(words: Words, gone: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The texts without some words, and how many lines of each went whole.

    A word goes with the white space after it, up to the end of its line; a line
    goes with its end if all its words go.
    """
    size, texts = len(words.data), len(words.offsets) - 1
    opening = np.flatnonzero(words.opens_line)
    line = np.cumsum(words.opens_line) - 1
    last = np.append(opening[1:], len(gone)) - 1
    owner = np.searchsorted(words.first[1:], opening, side="right")
    newlines = np.concatenate([[-1], np.flatnonzero(words.data == 10), [size]])
    place = np.searchsorted(newlines, words.starts[opening])
    line_begin = np.maximum(words.offsets[owner], newlines[place - 1] + 1)
    line_end = np.minimum(words.offsets[owner + 1], newlines[place])
    whole = np.logical_and.reduceat(gone, opening)
    out = np.flatnonzero(gone & ~whole[line])
    following = np.append(words.starts[1:], size)
    until = np.where(out == last[line[out]], line_end[line[out]], following[out])
    # White space ahead of a line's deleted end goes too.
    kept = np.maximum.reduceat(np.where(gone, -1, np.arange(len(gone))), opening)
    ragged = np.flatnonzero(~whole & gone[last])
    edge = np.zeros(size + 1, dtype=np.int64)
    for begin, end in ((words.starts[out], until), (words.ends[kept[ragged]], line_end[ragged]),
                       (line_begin[whole], np.minimum(line_end[whole] + 1, words.offsets[owner[whole] + 1]))):
        edge += np.bincount(begin, minlength=size + 1) - np.bincount(end, minlength=size + 1)
    stays = np.cumsum(edge)[:-1] == 0
    for i in owner[whole & (line_end == words.offsets[owner + 1])].tolist():
        # The text's last line went: so does the line end that stands last now.
        rest = np.flatnonzero(stays[words.offsets[i]:words.offsets[i + 1]])
        if len(rest):
            stays[words.offsets[i] + rest[-1]] = False
    ahead = np.concatenate([[0], np.cumsum(stays)])[words.offsets].astype(np.int64)
    left = pa.LargeStringArray.from_buffers(texts, pa.py_buffer(ahead), pa.py_buffer(words.data[stays]))
    return left.cast(pa.string()), np.bincount(owner[whole], minlength=texts)


def delete_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """The input rows with later repeated runs of words deleted, plus n_lines and deleted_lines.

    Runs of at least ``min_words`` words count; white space and line ends between them do not.
    Earlier means a smaller id, then an earlier word; rows without an id come
    first. Rows that repeat id and text are one document and are treated alike.
    ``deleted_lines`` counts lines that went whole; a line may also lose some of its
    words. Blank lines stay. Null text stays null, with no lines; an empty table gives
    an empty one. Extra columns n_lines, deleted_lines or of inner names are replaced or left out.
    """
    require_columns(docs, [id_col, text_col])
    docs = own_columns(docs, ["n_lines", "deleted_lines", "_doc_id", "_doc_hash", "_list_id", "_list_hash", "_matches", "_places"], [id_col, text_col])
    names = docs.columns
    keyed = docs.withColumns(dict(zip(["_doc_id", "_doc_hash"], document_key(id_col, text_col), strict=True)))
    joined = _with_lists(keyed, later_matches(keyed, id_col, text_col, min_words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, text_col):
                texts, deleted = part.column(text_col), np.zeros(part.num_rows, dtype=np.int64)
                n_lines = pc.fill_null(pc.add(pc.count_substring(texts, "\n").cast(pa.int64()), 1), 0)
                found = part.column("_matches")
                if found.null_count < part.num_rows:
                    words = read_words(pc.fill_null(texts, ""))
                    left, deleted = without_words(words, repeated_words(words, found, min_words))
                    texts = pc.if_else(texts.is_valid(), left, texts)
                columns = [texts if name == text_col else part.column(name) for name in names]
                yield pa.RecordBatch.from_arrays([*columns, n_lines, pa.array(deleted)], [*names, "n_lines", "deleted_lines"])

    schema = T.StructType([*docs.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("deleted_lines", T.LongType())])
    return joined.select(*names, "_matches").mapInArrow(run, schema)
