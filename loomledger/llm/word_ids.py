"""Token ids of a lower-casing word-end BPE vocabulary, as its library gives them.

White space only separates words for this vocabulary, so a text's ids are the
ids of its words one after another. Words are found and hashed for a whole
batch at once, and only what the worker's bounded memo does not know is encoded.
Words of ASCII and Latin-1 are cut further into runs of letters, single digits and
runs of others, in lower case, which a rank-based BPE encodes with a byte for the
word's end; any other word, and those with a quote or ``<``, are left whole and go
through the library itself.
"""

from __future__ import annotations

import functools
from itertools import chain

import numpy as np

from loomledger.llm.hashed import HashIndex, PieceHasher
from loomledger.llm.tokenizers_io import load_tokenizer, load_vocabulary, token_bytes

WORD_END = "</w>"
END_BYTE = b"\xff"  # never part of UTF-8
#: Pieces that a worker remembers and characters that it encodes at once: both bound its memory.
MEMO = 300_000
STREAM = 200_000
LONG = 200
# Kinds of code points: white space, and in plain words letters, digits, others. ODD ones make their word odd.
WHITE, LETTER, DIGIT, OTHER, ODD = range(5)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    kinds = np.full(0x110000, ODD, dtype=np.uint8)
    kinds[[32, *range(9, 14)]] = WHITE
    kinds[33:127] = OTHER
    kinds[[ord("'"), ord("<")]] = ODD
    kinds[48:58] = DIGIT
    capitals = [*range(65, 91), *range(0xC0, 0xD7), *range(0xD8, 0xDF)]
    small = [*range(97, 123), *range(0xDF, 0xF7), *range(0xF8, 0x100)]
    kinds[capitals + small] = LETTER
    lower = np.arange(256, dtype=np.uint32)
    lower[capitals] += 32
    return kinds, lower


KINDS, LOWER = _tables()


class WordEncoder:
    def __init__(self, path: str) -> None:
        import tiktoken

        vocab, merges, self.special = load_vocabulary(path)
        self.library = load_tokenizer(path)
        spell = lambda token: (token_bytes(token[:-len(WORD_END)]) + END_BYTE if token.endswith(WORD_END) else token_bytes(token))
        letters = [token for token in vocab if len(token.removesuffix(WORD_END)) == 1 and token not in self.special]
        order = [bytes([b]) for b in range(256)]
        order += sorted(spell(token) for token in letters if token.endswith(WORD_END))
        order += [spell(a + b) for a, b in merges]
        ranks = {raw: rank for rank, raw in enumerate(order)}
        ids = {spell(token): i for token, i in vocab.items() if token not in self.special}
        self.ids = np.array([ids.get(raw, -1) for raw in order], dtype=np.int64)
        self.fast = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe
        self.hasher = PieceHasher()
        self._forget()

    def _forget(self) -> None:
        self.memo = HashIndex()
        self.store = np.zeros(1 << 16, dtype=np.uint32)
        self.offsets = np.zeros(1 << 16, dtype=np.int64)
        self.known = 0

    def encode_word(self, word: str) -> list[int]:
        return self.library.encode(word, add_special_tokens=False).ids

    def _learn(self, keys: np.ndarray, pieces: list[str], odd: list[bool]) -> None:
        encode = self.fast.encode_single_piece
        lists = [[-1 - i for i in self.encode_word(piece)] if whole else encode(piece.lower().encode() + END_BYTE)
                 for piece, whole in zip(pieces, odd, strict=True)]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        used = int(self.offsets[self.known])
        while len(self.store) < used + sizes.sum():
            self.store = np.concatenate([self.store, np.zeros_like(self.store)])
        while len(self.offsets) < self.known + len(pieces) + 1:
            self.offsets = np.concatenate([self.offsets, np.zeros_like(self.offsets)])
        flat = np.fromiter(chain.from_iterable(lists), np.int64, int(sizes.sum()))
        self.store[used:used + len(flat)] = np.where(flat < 0, -1 - flat, self.ids[np.maximum(flat, 0)])
        self.offsets[self.known + 1:self.known + 1 + len(pieces)] = used + np.cumsum(sizes)
        self.memo.add(keys, np.arange(self.known, self.known + len(pieces), dtype=np.int32))
        self.known += len(pieces)

    def _long(self, piece: str, odd: bool) -> np.ndarray:
        ids = self.encode_word(piece) if odd else self.ids[self.fast.encode_single_piece(piece.lower().encode() + END_BYTE)]
        return np.array(ids, dtype=np.uint32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids (uint32) of every text."""
        out: list[np.ndarray] = []
        part: list[str] = []
        size = 0
        for text in texts:
            part.append(text)
            size += len(text)
            if size >= STREAM:
                out += self._stream(part)
                part, size = [], 0
        return out + (self._stream(part) if part else [])

    def _stream(self, texts: list[str]) -> list[np.ndarray]:
        joined = " ".join(texts) + " "
        codes = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
        kinds = KINDS[codes]
        black = kinds != WHITE
        change = np.flatnonzero(np.diff(black.view(np.int8), prepend=0, append=0))
        word_starts, word_ends = change[0::2], change[1::2]
        spoilt = np.concatenate([[0], np.cumsum(kinds == ODD)])
        whole = spoilt[word_ends] > spoilt[word_starts]
        for a, b in zip(word_starts[whole].tolist(), word_ends[whole].tolist(), strict=True):
            kinds[a:b] = ODD
        begins = black & ((np.diff(kinds, prepend=WHITE) != 0) | (kinds == DIGIT))
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(codes))
        ends = np.minimum(ends, word_ends[np.searchsorted(word_ends, starts, side="right")])
        odd = kinds[starts] == ODD
        codes = np.where(kinds == ODD, codes, LOWER[np.minimum(codes, 255)])
        stops = np.cumsum([len(text) + 1 for text in texts])
        first_word = np.searchsorted(starts, np.concatenate([[0], stops]))
        keys = self.hasher.hashes(codes, starts, ends) & ~1 | odd
        if self.known > MEMO or len(self.store) > 16 * MEMO:
            self._forget()
        index = self.memo.get(keys).astype(np.int64)
        long = np.flatnonzero(ends - starts > LONG)
        unknown = np.flatnonzero((index < 0) & (ends - starts <= LONG))
        if len(unknown):
            fresh, first, back = np.unique(keys[unknown], return_index=True, return_inverse=True)
            places = unknown[first]
            index[unknown] = self.known + back
            self._learn(fresh, [joined[a:b] for a, b in zip(starts[places].tolist(), ends[places].tolist(), strict=True)],
                        odd[places].tolist())
        index[long] = 0
        low, size = self.offsets[index], self.offsets[index + 1] - self.offsets[index]
        size[long] = 0
        total = np.concatenate([[0], np.cumsum(size)])
        gather = np.arange(total[-1]) + np.repeat(low - total[:-1], size)
        flat = self.store[gather]
        bounds = total[first_word]
        texts_ids = [flat[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        for number in np.unique(np.searchsorted(stops, starts[long], side="right")).tolist():
            words = range(first_word[number], first_word[number + 1])
            texts_ids[number] = np.concatenate([
                self._long(joined[starts[w]:ends[w]], bool(odd[w])) if ends[w] - starts[w] > LONG
                else flat[total[w]:total[w + 1]] for w in words])
        return texts_ids


@functools.lru_cache(maxsize=1)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)
