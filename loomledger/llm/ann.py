"""Nearest neighbours by randomly rotated one-bit codes.

Every vector is scaled to length one, rotated by a fixed random rotation and kept
as one bit per dimension (the sign), together with one correction scalar: the
inner product of the rotated vector and its code taken as a vector of length
one. For a query, the inner product with the code, divided by that scalar,
estimates the cosine; ``sqrt((1 - s^2) / s^2 / (D - 1))`` times ``SPREAD`` bounds the
error. The vectors whose upper bound reaches the k-th best score seen so far are
reranked with the original vectors in double precision; all others are out.

The index holds a code for every row. The query set is cut into blocks of some
thousands, each small enough for one task; each block meets all codes in one
narrow pass, keeps its k best per task, and only these are shuffled. So the
work is queries times rows in bit codes, and a query block is the only thing
sent to all tasks (at most ``8 * QUERY_BLOCK`` vectors, checked).
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomledger.llm.common import require_columns, settle, ship_package

QUERY_BLOCK = 2048
ROW_BLOCK = 2048
SPREAD = 3.5
SEED = 20
#: Below so many dimensions the bound says little, so all are reranked.
FEW_DIMENSIONS = 8


@functools.lru_cache(maxsize=8)
def rotation(dimensions: int, seed: int = SEED) -> np.ndarray:
    """A random rotation, the same everywhere."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dimensions]).standard_normal((dimensions, dimensions)))
    return q * np.sign(np.diag(r))


def usable(vector: Column) -> Column:
    """Not null, not zero, and all components finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    return (vector.isNotNull() & F.coalesce(F.forall(vector, finite), F.lit(False))
            & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False)))


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign bits and correction scalars of row vectors."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    turned = unit @ rotation(vectors.shape[1]).T
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(axis=1) / np.sqrt(vectors.shape[1])


def build_index(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, vector, code, scalar) of every usable row."""
    ship_package(vectors.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes: list[bytes] = [b""] * batch.num_rows
            scalars = np.zeros(batch.num_rows)
            for rows, matrix in _by_dimension(batch.column("vector")):
                bits, scalar = encode(matrix)
                scalars[rows] = scalar
                for row, code in zip(rows.tolist(), bits, strict=True):
                    codes[row] = code.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("vector"), pa.array(codes, pa.binary()), pa.array(scalars)],
                ["vec_id", "vector", "code", "scalar"])

    rows = (vectors.filter(F.col(id_col).isNotNull() & usable(F.col(vector_col)))
            .select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")))
    return rows.mapInArrow(run, "vec_id long, vector array<double>, code binary, scalar double")


def _by_dimension(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and matrix of the vectors of each length."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False)
    low = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    for size in np.unique(lengths):
        rows = np.flatnonzero(lengths == size)
        yield rows, values[low[rows][:, None] + np.arange(size)]


class BlockSearch:
    """The k best of a stream of coded rows for each query of a block, all of one dimension."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int) -> None:
        self.ids, self.queries, self.k = ids, queries, k
        self.norms = np.linalg.norm(queries, axis=1)
        dimensions = queries.shape[1]
        self.turned = ((queries / self.norms[:, None]) @ rotation(dimensions).T).astype(np.float32) / np.float32(np.sqrt(dimensions))
        self.best = [np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)]  # query place, vec_id, score
        self.floor = np.full(len(ids), -np.inf)

    def add(self, vec_ids: np.ndarray, vectors: np.ndarray, codes: np.ndarray, scalars: np.ndarray) -> None:
        dimensions = vectors.shape[1]
        signs = np.unpackbits(codes, axis=1, count=dimensions).astype(np.float32) * 2 - 1
        guess = (self.turned @ signs.T) / scalars.astype(np.float32)
        guess[self.ids[:, None] == vec_ids[None, :]] = -np.inf
        error = np.sqrt(np.maximum(0, 1 - scalars**2)) / scalars / np.sqrt(max(dimensions - 1, 1)) * SPREAD
        if dimensions < FEW_DIMENSIONS:
            error = np.full(len(scalars), 4.0)
        # The likeliest first: their exact scores raise the floor.
        first = min(self.k, len(vec_ids))
        likely = np.argpartition(-guess, first - 1, axis=1)[:, :first]
        q = np.repeat(np.arange(len(self.ids)), first)
        self._rerank(q, likely.reshape(-1), guess, vec_ids, vectors)
        np.put_along_axis(guess, likely, -np.inf, axis=1)
        q, row = np.nonzero(guess + error.astype(np.float32) >= (self.floor - 1e-6).astype(np.float32)[:, None])
        self._rerank(q, row, guess, vec_ids, vectors)

    def _rerank(self, q: np.ndarray, row: np.ndarray, guess: np.ndarray, vec_ids: np.ndarray, vectors: np.ndarray) -> None:
        inside = np.isfinite(guess[q, row])
        q, row = q[inside], row[inside]
        norms = np.linalg.norm(vectors, axis=1)
        for low in range(0, len(q), 100_000):
            a, b = q[low:low + 100_000], row[low:low + 100_000]
            score = np.einsum("ij,ij->i", self.queries[a], vectors[b]) / (self.norms[a] * norms[b])
            near = score >= self.floor[a]
            places, ids, scores = (np.concatenate(pair) for pair in zip(self.best, (a[near], vec_ids[b[near]], score[near]), strict=True))
            order = np.lexsort((ids, -scores, places))
            places, ids, scores = places[order], ids[order], scores[order]
            begins = np.searchsorted(places, places)
            keep = np.arange(len(places)) - begins < self.k
            self.best = [places[keep], ids[keep], scores[keep]]
            places, scores = self.best[0], self.best[2]
            last = np.flatnonzero(np.append(places[1:] != places[:-1], True)) if len(places) else np.zeros(0, dtype=np.int64)
            full = np.bincount(places, minlength=len(self.ids))[places[last]] >= self.k
            self.floor[places[last[full]]] = scores[last[full]]


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of largest cosine for every query.

    A query's own id is no candidate; equal scores go to the smaller vec_id.
    Vectors that are null, zero, or hold null or non-finite components, and
    rows without an id, take no part. Vectors meet only those of their own
    length. Queries that repeat id and vector count once; rows are all
    candidates, repeated ones too. Fewer than k candidates are all returned.
    """
    require_columns(vectors, [id_col, vector_col])
    spark = vectors.sparkSession
    index = settle(build_index(vectors, id_col, vector_col), "codes")
    asked = (queries.filter(F.col(id_col).isNotNull() & usable(F.col(vector_col)))
             .select(F.col(id_col).cast("long").alias("query_id"), F.col(vector_col).cast("array<double>").alias("vector")).distinct())
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    asked = settle(asked.withColumn("block", F.pmod(F.xxhash64("query_id", "vector"), F.lit(blocks))), "queries")
    found = []
    for block in range(blocks):
        rows = asked.filter(F.col("block") == block).limit(8 * QUERY_BLOCK + 1).collect()
        if len(rows) > 8 * QUERY_BLOCK:
            raise RuntimeError("a query block is larger than its bound")
        if rows or block == 0:
            found.append(_search(index, [(row[0], row[1]) for row in rows], k))
            if blocks > 1:
                found[-1] = settle(_best(found[-1], k), "nearest")
    result = functools.reduce(DataFrame.union, found)
    return (_best(result, k) if blocks == 1 else result).select("query_id", "rank", "vec_id", "score")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id", "query_place").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k)


def _search(index: DataFrame, block: list[tuple[int, list[float]]], k: int) -> DataFrame:
    context = index.sparkSession.sparkContext
    by_size: dict[int, list[int]] = {}
    for place, (_, vector) in enumerate(block):
        by_size.setdefault(len(vector), []).append(place)
    groups = {size: (np.array(places), np.array([block[p][0] for p in places]), np.array([block[p][1] for p in places]))
              for size, places in by_size.items()}
    sent = context.broadcast(groups)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = {size: BlockSearch(ids, matrix, k) for size, (_, ids, matrix) in sent.value.items()}
        for batch in batches:
            ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
            scalars = batch.column("scalar").to_numpy(zero_copy_only=False)
            codes = batch.column("code")
            for rows, matrix in _by_dimension(batch.column("vector")):
                search = searches.get(matrix.shape[1])
                if search is None:
                    continue
                packed = np.frombuffer(b"".join(codes.take(pa.array(rows)).to_pylist()), dtype=np.uint8).reshape(len(rows), -1)
                for low in range(0, len(rows), ROW_BLOCK):
                    part = slice(low, low + ROW_BLOCK)
                    search.add(ids[rows[part]], matrix[part], packed[part], scalars[rows[part]])
        for size, search in searches.items():
            places, vec_ids, scores = search.best
            yield pa.RecordBatch.from_arrays(
                [pa.array(sent.value[size][0][places]), pa.array(search.ids[places]), pa.array(vec_ids), pa.array(scores)],
                ["query_place", "query_id", "vec_id", "score"])

    return index.mapInArrow(run, "query_place long, query_id long, vec_id long, score double")
