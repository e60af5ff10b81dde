"""Connected components of a graph of integer nodes, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomledger.llm.common import settle


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its smallest node.

    Large-star and small-star rounds bring every node next to the smallest node
    of its component in a number of rounds that grows with the logarithm of the
    component's size. A hub's neighbours are reduced to their minimum before the
    shuffle and joined back by key, where skewed keys can be split. Each round is
    written to the shared folder.
    """
    current = settle(_tidy(edges), "edges")
    mark = _mark(current)
    for _ in range(max_rounds):
        both = current.select("a", "b").union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
        large = both.filter(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        current = _tidy(large)
        # Small star: every node (a) and its smaller neighbours (b) meet at the smallest of them.
        least = current.groupBy("a").agg(F.min("b").alias("least"))
        small = (current.join(least, "a").filter(F.col("b") != F.col("least")).select(F.col("b").alias("a"), F.col("least").alias("b"))
                 .union(least.select("a", F.col("least").alias("b"))))
        current = settle(_tidy(small), "edges")
        before, mark = mark, _mark(current)
        if mark == before:
            hubs = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(hubs)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _tidy(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger to the smaller node."""
    return edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _mark(edges: DataFrame) -> tuple[int, int]:
    """Number and order-free checksum of the edges."""
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
    return row[0], row[1] or 0
