"""Repeatable random draws: a hash of the row's key instead of a generator.

A draw depends only on seed, purpose and key, so rows can be generated in
any order on any number of executors, and a lost partition is recomputed
to the same values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 52 bits: exact in a double, and no two rows of a large table share a draw by chance.
_SCALE = 4503599627370496.0


class Draws:
    """Draws for one kind of row; ``key`` identifies the row within it."""

    def __init__(self, seed: int, kind: str, *key: Column):
        self.seed = seed
        self.kind = kind
        self.key = key

    def digest(self, purpose: str) -> Column:
        return F.md5(F.concat_ws("|", F.lit(f"{self.seed}|{self.kind}|{purpose}"), *[k.cast("string") for k in self.key]))

    def uniform(self, purpose: str) -> Column:
        """In [0, 1)."""
        # By way of a whole number: parsing the decimal text as a double costs more.
        return F.conv(F.substring(self.digest(purpose), 1, 13), 16, 10).cast("bigint").cast("double") / F.lit(_SCALE)

    def chance(self, purpose: str, p: float) -> Column:
        return self.uniform(purpose) < p

    def whole(self, purpose: str, low: int | Column, high: int | Column) -> Column:
        """A whole number in low..high, both included."""
        low = F.lit(low) if isinstance(low, int) else low
        high = F.lit(high) if isinstance(high, int) else high
        return low + F.floor(self.uniform(purpose) * (high - low + 1))

    def between(self, purpose: str, low: float | Column, high: float | Column) -> Column:
        low = F.lit(low) if isinstance(low, float) else low
        high = F.lit(high) if isinstance(high, float) else high
        return low + self.uniform(purpose) * (high - low)

    def normal(self, purpose: str, deviation: float) -> Column:
        """Normal around 0, from two uniforms."""
        radius = F.sqrt(F.lit(-2.0) * F.ln(F.lit(1.0) - self.uniform(f"{purpose}/r")))
        return radius * F.cos(self.uniform(f"{purpose}/a") * 6.283185307179586) * deviation

    def pick(self, purpose: str, values: list[object]) -> Column:
        index = F.floor(self.uniform(purpose) * len(values)) + 1
        return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int"))

    def identifier(self, purpose: str = "id") -> Column:
        """A UUID-shaped id."""
        return F.regexp_replace(self.digest(purpose), r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def cents(value: Column) -> Column:
    """Down to whole cents."""
    return F.floor(value * 100) / 100.0
