"""A hash index for whole arrays, and hashes of many pieces of one text at once."""

from __future__ import annotations

import numpy as np

_MIX = np.uint64(0x9E3779B97F4A7C15)


class HashIndex:
    """Open addressing over numpy arrays; keys are not negative, absent keys give -1."""

    def __init__(self, keys: np.ndarray | None = None, values: np.ndarray | None = None) -> None:
        self.count = 0
        self._resize(16)
        if keys is not None and len(keys):
            self.add(keys, values)

    def _resize(self, bits: int) -> None:
        self.bits = bits
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.values = np.full(1 << bits, -1, dtype=np.int32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Add distinct keys that are not present yet."""
        if (self.count + len(keys)) * 2 > len(self.keys):
            held = self.keys >= 0
            old_keys, old_values = self.keys[held], self.values[held]
            self._resize(max(self.bits + 1, int(self.count + len(keys)).bit_length() + 1))
            self.count = 0
            if len(old_keys):
                self.add(old_keys, old_values)
        self.count += len(keys)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            at = slot[left]
            free = self.keys[at] == -1
            self.keys[at[free]] = keys[left[free]]  # of several for one slot the last stays
            won = self.keys[at] == keys[left]
            self.values[at[won]] = values[left[won]]
            left = left[~won]
            slot[left] = (slot[left] + 1) & (len(self.keys) - 1)

    def get(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        held = self.keys[slot]
        out = self.values[slot]
        left = np.flatnonzero((held != keys) & (held != -1))
        while len(left):
            at = (slot[left] + 1) & (len(self.keys) - 1)
            slot[left] = at
            held = self.keys[at]
            out[left] = self.values[at]
            left = left[(held != keys[left]) & (held != -1)]
        return out


class PieceHasher:
    """63-bit hashes of pieces of a text, by a polynomial over mixed code points and running sums."""

    BASE = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self) -> None:
        self.powers = self.inverses = np.ones(0, dtype=np.uint64)

    def hashes(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(self.powers) < len(codes):
            steps = np.full(len(codes), self.BASE, dtype=np.uint64)
            steps[0] = 1
            self.powers = np.cumprod(steps)
            steps[1:] = pow(int(self.BASE), -1, 1 << 64)
            self.inverses = np.cumprod(steps)
        mixed = codes.astype(np.uint64) + np.uint64(1)
        mixed *= np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(32)
        mixed *= self.powers[:len(codes)]
        sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mixed)])
        value = (sums[ends] - sums[starts]) * self.inverses[starts]
        value ^= value >> np.uint64(29)
        value = value * np.uint64(0xBF58476D1CE4E5B9) + (ends - starts).astype(np.uint64)
        return (value >> np.uint64(1)).astype(np.int64)
