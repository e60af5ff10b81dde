"""Token counts by compiled finite-state transducers.

Two transducers do the work of a byte-level BPE tokenizer, without building
tokens:

* **Cutting.** A transducer of twelve states over twelve character classes
  marks where pre-tokens start; a mark may come one character late, because
  white space and contractions need a look ahead. Texts of a batch form one
  stream with end marks, cut into chunks of equal length that advance together.
  Each chunk first gives its state map (entry state to exit state), followed
  for all entry states until they meet. The maps compose by a parallel prefix
  scan, which gives every chunk its entry state; a second walk emits the marks.
* **Counting.** Inside a pre-token the encoding of a prefix ends in one token,
  and that token and the prefix before it decide everything: a token may follow
  another if no earlier merge joins the two. The state after a position is that
  last token together with those of the positions before; its transition is
  annotated with the number of tokens emitted. Candidate tokens come from the
  vocabulary's trie, both trie and follow relation being compiled from the
  merges. Distinct pre-tokens of a batch advance side by side; their counts
  are kept in a bounded memo per worker.

Character classes are asked from the tokenizer itself, once, on the driver (one
byte per code point, 1.1 MB, a fixed size).
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomledger.llm.common import require_columns, ship_package, whole_text
from loomledger.llm.hashed import HashIndex, PieceHasher
from loomledger.llm.tokenizers_io import load_tokenizer, load_vocabulary, token_bytes, vocabulary_path

# Character classes. A..E are letters that may continue a contraction.
LETTER, NUMBER, OTHER, SPACE, BLANK, QUOTE, STMD, RE_R, VE_V, E, ELL, END = range(12)
CLASSES = 12
# States: after which character the stream stands.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHER, ONE_SPACE, SPACES, ONE_BLANK, BLANKS, AT_QUOTE, QUOTE_R, QUOTE_V, QUOTE_L = range(12)
STATES = 12
HERE, BEFORE = 1, 2  # a pre-token starts at this character, or at the one before
CHUNK = 256
STREAM = 1_000_000
MEMO = 1_500_000
FOLLOW_MEMO = 1_000_000
LONG = 64


def _cutting_tables() -> tuple[np.ndarray, np.ndarray]:
    """Next state and marks by state and class."""
    goes = np.zeros((STATES, CLASSES), dtype=np.uint8)
    marks = np.zeros((STATES, CLASSES), dtype=np.uint8)
    letters = (LETTER, STMD, RE_R, VE_V, E, ELL)
    for state in range(STATES):
        for kind in range(CLASSES):
            at, late = state, 0
            if state in (QUOTE_R, QUOTE_V, QUOTE_L):
                ending = {QUOTE_R: E, QUOTE_V: E, QUOTE_L: ELL}[state]
                if kind == ending:
                    goes[state, kind] = FRESH
                    continue
                at, late = IN_LETTERS, BEFORE  # no contraction: the letter began a pre-token
            if kind == END:
                goes[state, kind], marks[state, kind] = FRESH, HERE | late
                continue
            if kind in letters:
                to, mark = IN_LETTERS, HERE
                if at in (IN_LETTERS, ONE_SPACE):
                    mark = 0
                elif at == SPACES:
                    mark = BEFORE
                elif at == BLANKS:
                    mark = HERE | BEFORE
                elif at == AT_QUOTE and kind == STMD:
                    to, mark = FRESH, 0
                elif at == AT_QUOTE and kind in (RE_R, VE_V, ELL):
                    to, mark = {RE_R: QUOTE_R, VE_V: QUOTE_V, ELL: QUOTE_L}[kind], 0
            elif kind == NUMBER:
                to, mark = IN_NUMBERS, {IN_NUMBERS: 0, ONE_SPACE: 0, SPACES: BEFORE, BLANKS: HERE | BEFORE}.get(at, HERE)
            elif kind in (OTHER, QUOTE):
                to, mark = IN_OTHER, {IN_OTHER: 0, AT_QUOTE: 0, ONE_SPACE: 0, SPACES: BEFORE, BLANKS: HERE | BEFORE}.get(at, HERE)
                if kind == QUOTE and mark & HERE:
                    to = AT_QUOTE
            else:
                run = at in (ONE_SPACE, SPACES, ONE_BLANK, BLANKS)
                to = {(SPACE, False): ONE_SPACE, (SPACE, True): SPACES, (BLANK, False): ONE_BLANK, (BLANK, True): BLANKS}[kind, run]
                mark = 0 if run else HERE
            goes[state, kind], marks[state, kind] = to, mark | late
    return goes, marks


GOES, MARKS = _cutting_tables()


def character_classes(path: str) -> bytes:
    """The class of every code point, as the tokenizer's own pre-tokenizer sees it.

    A code point belongs to the class whose sample it joins. The class that
    Unicode suggests is tried first, then all; what joins none is white space.
    """
    cut = load_tokenizer(path).pre_tokenizer
    table = np.full(0x110000, OTHER, dtype=np.uint8)
    samples = {LETTER: "a", NUMBER: "1", OTHER: "!"}

    def joins(points: list[int], kind: int) -> np.ndarray:
        out = []
        for low in range(0, len(points), 500):
            part = points[low:low + 500]
            text = "".join(f"{samples[kind]}{chr(p)}\n\n" for p in part)
            starts = np.zeros(len(text) + 1, dtype=bool)
            starts[[span[0] for _, span in cut.pre_tokenize_str(text)]] = True
            out.append(~starts[1:len(text):4])
        return np.concatenate(out) if out else np.zeros(0, dtype=bool)

    # Letters, numbers and white space lie in the first four planes; higher ones hold marks and private use.
    suggested = {"L": LETTER, "N": NUMBER}
    groups: dict[int, list[int]] = {LETTER: [], NUMBER: [], OTHER: []}
    for point in range(0x40000):
        if not 0xD800 <= point < 0xE000:
            groups[suggested.get(unicodedata.category(chr(point))[0], OTHER)].append(point)
    doubtful: list[int] = []
    for kind, points in groups.items():
        agree = joins(points, kind)
        table[np.array(points)[agree]] = kind
        doubtful += np.array(points)[~agree].tolist()
    table[doubtful] = BLANK
    for kind in samples:
        table[np.array(doubtful, dtype=np.int64)[joins(doubtful, kind)]] = kind
    table[ord(" ")], table[ord("'")] = SPACE, QUOTE
    for letters, kind in (("stmd", STMD), ("r", RE_R), ("v", VE_V), ("e", E), ("l", ELL)):
        for letter in letters:
            table[ord(letter)] = kind
    return table.tobytes()


def state_maps(chunks: np.ndarray) -> np.ndarray:
    """Exit state of every chunk (a column of ``chunks``) for every entry state."""
    length, count = chunks.shape
    maps = np.broadcast_to(np.arange(STATES, dtype=np.uint8), (count, STATES)).copy()
    met = 0
    for met in range(min(8, length)):
        maps = GOES[maps, chunks[met][:, None]]
    rest = min(8, length)
    same = (maps == maps[:, :1]).all(axis=1)
    one, classes = maps[same, 0], chunks[:, same]
    many, others = maps[~same], chunks[:, ~same]
    for row in range(rest, length):
        one = GOES[one, classes[row]]
        if len(many):
            many = GOES[many, others[row][:, None]]
    maps[same] = one[:, None]
    maps[~same] = many
    return maps


def scan_maps(maps: np.ndarray) -> np.ndarray:
    """Composition of each chunk's map with all before it, by doubling strides."""
    out, stride = maps.copy(), 1
    while stride < len(out):
        out[stride:] = np.take_along_axis(out[stride:], out[:-stride], axis=1)
        stride *= 2
    return out


def pretoken_starts(classes: np.ndarray) -> np.ndarray:
    """Positions in a stream of classes at which pre-tokens (and end marks) start."""
    count = -(-len(classes) // CHUNK)
    padded = np.full(count * CHUNK, END, dtype=np.uint8)
    padded[:len(classes)] = classes
    chunks = np.ascontiguousarray(padded.reshape(count, CHUNK).T)
    scanned = scan_maps(state_maps(chunks))
    state = np.concatenate([[FRESH], scanned[:-1, FRESH]]).astype(np.uint8)
    marks = np.empty_like(chunks)
    for row in range(CHUNK):
        marks[row] = MARKS[state, chunks[row]]
        state = GOES[state, chunks[row]]
    flat = marks.T.reshape(-1)[:len(classes)]
    begins = (flat & HERE).astype(bool)
    begins[:-1] |= (flat[1:] & BEFORE).astype(bool)
    return np.flatnonzero(begins)


class Transducer:
    """The counting transducer, compiled from a byte-level vocabulary."""

    def __init__(self, path: str) -> None:
        vocab, merges, _ = load_vocabulary(path)
        spell = {token: token_bytes(token) for token in vocab if all(ord(c) < 512 for c in token) and not token.startswith("<|")}
        size = max(vocab.values()) + 1
        # A token's rank is its merge's place; single bytes have none and come first.
        self.rank = np.zeros(size, dtype=np.int64)
        self.left = np.full(size, -1, dtype=np.int64)
        self.right = np.full(size, -1, dtype=np.int64)
        pairs = {}
        for place, (a, b) in enumerate(merges, 1):
            made, x, y = vocab[a + b], vocab[a], vocab[b]
            self.rank[made], self.left[made], self.right[made] = place, x, y
            pairs[x << 20 | y] = place
        self.pairs = HashIndex(np.array(list(pairs), dtype=np.int64), np.array(list(pairs.values()), dtype=np.int32))
        # The trie of all tokens reachable by merges: edges by node and byte.
        edges: dict[int, int] = {}
        ends: dict[int, int] = {}
        for token, raw in spell.items():
            at = 0
            for byte in raw:
                at = edges.setdefault(at << 8 | byte, len(edges) + 1)
            if len(raw) == 1 or self.rank[vocab[token]]:
                ends[at] = vocab[token]
        self.edges = edges
        self.steps = HashIndex(np.array(list(edges), dtype=np.int64), np.array(list(edges.values()), dtype=np.int32))
        self.node_token = np.full(len(edges) + 1, -1, dtype=np.int64)
        self.node_token[list(ends)] = list(ends.values())
        self.follow_memo = HashIndex()
        self.memo = HashIndex()
        self.hasher = PieceHasher()

    def follows(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether the second token can stand right after the first in an encoding.

        Going back through the merges that formed the two, the symbols at the
        border must never have had a merge of their own that came earlier.
        """
        x, y = first.copy(), second.copy()
        ok = np.ones(len(x), dtype=bool)
        limit = np.full(len(x), np.iinfo(np.int64).max)
        live = np.arange(len(x))
        while len(live):
            a, b = x[live], y[live]
            place = self.pairs.get(a << 20 | b)
            crossed = (place >= 0) & (place < limit[live])
            ok[live[crossed]] = False
            ra, rb = self.rank[a], self.rank[b]
            split_a = ra > rb
            # Of two equal merges the left one comes first, so a right token yields one place earlier.
            limit[live] = np.where(split_a, ra, rb + 1)
            x[live] = np.where(split_a, self.right[a], a)
            y[live] = np.where(split_a, b, np.where(rb > 0, self.left[b], b))
            live = live[~crossed & (np.maximum(ra, rb) > 0)]
        return ok

    def _follows(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        keys = first.astype(np.int64) << 20 | second
        known = self.follow_memo.get(keys)
        unknown = np.flatnonzero(known < 0)
        if len(unknown):
            if self.follow_memo.count > FOLLOW_MEMO:
                self.follow_memo = HashIndex()
            fresh, back = np.unique(keys[unknown], return_inverse=True)
            ok = self.follows(fresh >> 20, fresh & 0xFFFFF).astype(np.int32)
            absent = self.follow_memo.get(fresh) < 0
            self.follow_memo.add(fresh[absent], ok[absent])
            known[unknown] = ok[back]
        return known == 1

    def count_pretokens(self, words: list[bytes]) -> np.ndarray:
        """Tokens of each pre-token; all advance together, position by position."""
        lengths = np.array([len(word) for word in words], dtype=np.int64)
        stream = np.frombuffer(b"".join(words), dtype=np.uint8).astype(np.int64)
        last_of = np.repeat(np.cumsum(lengths), lengths)  # end of the word, by position
        begin = last_of - np.repeat(lengths, lengths)
        # All tokens of the trie at all positions: (start, end, token).
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        start, node, depth = np.arange(len(stream)), np.zeros(len(stream), dtype=np.int64), 0
        while len(start):
            node = self.steps.get(node << 8 | stream[start + depth])
            depth += 1
            goes = node >= 0
            start, node = start[goes], node[goes].astype(np.int64)
            token = self.node_token[node]
            hit = token >= 0
            found.append((start[hit], start[hit] + depth, token[hit]))
            inside = start + depth < last_of[start]
            start, node = start[inside], node[inside]
        starts, ends, tokens = (np.concatenate(part) for part in zip(*found, strict=True))
        place = ends - begin[starts]
        order = np.argsort(place, kind="stable")
        starts, ends, tokens, place = starts[order], ends[order], tokens[order], place[order]
        last = np.full(len(stream), -1, dtype=np.int64)  # the last token of the prefix that ends here
        emitted = np.zeros(len(stream), dtype=np.int64)
        edges = np.flatnonzero(np.diff(place, prepend=0, append=place[-1] + 1))
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            s, e, t = starts[low:high], ends[low:high], tokens[low:high]
            fresh = s == begin[s]
            before = np.where(fresh, 0, s - 1)
            fits = fresh.copy()
            inner = np.flatnonzero(~fresh & (last[before] >= 0))
            if len(inner):
                fits[inner] = self._follows(last[before[inner]], t[inner])
            s, e, t, fresh, before = s[fits], e[fits], t[fits], fresh[fits], before[fits]
            last[e - 1] = t
            emitted[e - 1] = np.where(fresh, 0, emitted[before]) + 1
        return emitted[np.cumsum(lengths) - 1]

    def count_long(self, word: bytes) -> int:
        """The same walk for one long pre-token, without arrays per position."""
        nodes = self.edges
        tokens = self.node_token
        last, emitted = [-1] * (len(word) + 1), [0] * (len(word) + 1)
        known = self._pair_memo()
        for start in range(len(word)):
            if start and last[start] < 0:
                continue
            node, at = 0, start
            while at < len(word) and (node := nodes.get(node << 8 | word[at], -1)) >= 0:
                at += 1
                token = int(tokens[node])
                if token < 0 or last[at] >= 0:
                    continue
                if start:
                    key = last[start] << 20 | token
                    if key not in known:
                        known[key] = bool(self.follows(np.array([last[start]]), np.array([token]))[0])
                    if not known[key]:
                        continue
                last[at], emitted[at] = token, emitted[start] + 1
        return emitted[-1]

    def _pair_memo(self) -> dict[int, bool]:
        memo = self.__dict__.setdefault("_pairs", {})
        if len(memo) > 1_000_000:
            memo.clear()
        return memo

    def counts(self, text: str, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens of the pre-tokens at the given places of a text.

        The memo knows a pre-token by a 63-bit hash and is emptied when full;
        pre-tokens of more than ``LONG`` characters bypass it.
        """
        keys = self.hasher.hashes(codes, starts, ends)
        out = self.memo.get(keys).astype(np.int64)
        lengths = ends - starts
        for at in np.flatnonzero(lengths > LONG).tolist():
            out[at] = self.count_long(text[starts[at]:ends[at]].encode())
        unknown = np.flatnonzero((out < 0) & (lengths <= LONG))
        if len(unknown):
            if self.memo.count > MEMO:
                self.memo = HashIndex()
            fresh, first, back = np.unique(keys[unknown], return_index=True, return_inverse=True)
            places = unknown[first]
            words = [text[a:b].encode() for a, b in zip(starts[places].tolist(), ends[places].tolist(), strict=True)]
            counted = np.concatenate([self.count_pretokens(words[low:low + 50_000]) for low in range(0, len(words), 50_000)])
            out[unknown] = counted[back]
            absent = self.memo.get(fresh) < 0
            self.memo.add(fresh[absent], counted[absent].astype(np.int32))
        return out


class Counter:
    """Counts tokens of whole texts; special strings count as one token each, as the library takes them."""

    def __init__(self, path: str, classes: bytes) -> None:
        self.classes = np.frombuffer(classes, dtype=np.uint8)
        self.transducer = Transducer(path)
        self.special = load_vocabulary(path)[2]

    def count(self, texts: list[str]) -> list[int]:
        out: list[int] = []
        part: list[str] = []
        size = 0
        for text in texts:
            part.append(text)
            size += len(text)
            if size >= STREAM:
                out += self._stream(part)
                part, size = [], 0
        return out + (self._stream(part) if part else [])

    def _stream(self, texts: list[str]) -> list[int]:
        totals = [0] * len(texts)
        segments: list[str] = []
        owner: list[int] = []
        for i, text in enumerate(texts):
            parts = [text]
            for special in self.special:
                parts = [piece for part in parts for piece in part.split(special)]
            totals[i] += len(parts) - 1
            segments += parts
            owner += [i] * len(parts)
        joined = "\n".join(segments) + "\n"
        codes = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
        classes = self.classes[codes]
        stops = np.cumsum([len(segment) + 1 for segment in segments]) - 1
        classes[stops] = END
        starts = pretoken_starts(classes)
        real = classes[starts] != END
        ends = np.append(starts[1:], len(joined))
        counts = self.transducer.counts(joined, codes, starts[real], ends[real])
        segment_of = np.searchsorted(stops, starts[real])
        sums = np.bincount(np.array(owner)[segment_of], weights=counts, minlength=len(texts))
        return [int(total + extra) for total, extra in zip(sums, totals, strict=True)]


@functools.lru_cache(maxsize=2)
def _counter(path: str, classes: bytes) -> Counter:
    return Counter(path, classes)


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 vocabulary: str | None = None, limit: int = 512) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    Whole texts are counted; null counts as empty, and empty texts have no
    tokens. Ids may be null or repeat, other columns are ignored, an empty
    table gives an empty result.
    """
    require_columns(docs, [id_col, text_col])
    ship_package(docs.sparkSession)
    path = vocabulary_path("byte_bpe_50k.json", vocabulary)
    classes = docs.sparkSession.sparkContext.broadcast(character_classes(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path, classes.value)
        for batch in batches:
            for low in range(0, batch.num_rows, 2000):
                part = batch.slice(low, 2000)
                counts = counter.count(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("n_bytes"), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    text = whole_text(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    counted = rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
