"""Nearest neighbours by inner product, as a block matrix join.

Queries and candidates are dealt into blocks by id hash; each pair of blocks meets in one tile. There both
are quantised to int8 with a scale per vector. The product of the int8 tiles gives every inner
product up to a bound that follows from the quantisation errors (|x.y - x'.y'| <= |x'| |y - y'| +
|x - x'| |y|). Candidates whose upper bound reaches the k-th largest lower bound of their query
survive and are computed again in double precision, adding components in order. The tiles'
best are merged by one bounded heap per query. The result is exact.

Of candidates with one and the same vector a tile keeps only the k + 1 smallest ids: no more of
them can be among the k nearest.

Results in special cases: vectors that are NULL, empty, zero or hold a NULL or non-finite component,
and rows with a NULL id, take no part; rows that share an id count each for themselves, as candidates (a row is
only never its own) and as queries (one ranking per row); vectors of
different length are not compared; with fewer candidates than k all are returned; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .batches import pick

K = 20
QUERY_TILE, CANDIDATE_TILE = 8192, 4096
# Products of a tile held at once.
CELLS = 1 << 20
# Relative error of double arithmetic on the bounds themselves.
SLACK = 1e-9


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector (doubles) of the rows that take part."""
    plain = pick(vectors, "vec_id", "embedding").select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    fit = F.forall("vector", lambda x: F.coalesce(finite(x), F.lit(False))) & F.exists("vector", lambda x: x != 0)
    return plain.where(F.col("vec_id").isNotNull() & F.coalesce(fit, F.lit(False)))


class Quantised:
    """Rows as int8 times a scale, with the norms that bound the error."""

    def __init__(self, rows: np.ndarray):
        self.scale = np.abs(rows).max(axis=1) / 127
        self.int8 = np.rint(rows / self.scale[:, None]).astype(np.int8)
        near = self.int8 * self.scale[:, None]
        self.near_norm = np.linalg.norm(near, axis=1)
        self.error = np.linalg.norm(rows - near, axis=1)
        self.norm = np.linalg.norm(rows, axis=1)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in column.chunks]) if column.num_chunks else pa.array([], pa.float64())
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _few_of_each(ids: np.ndarray, rows: np.ndarray, most: int) -> np.ndarray:
    """Places of the rows that are among the ``most`` smallest ids of their vector."""
    _, same = np.unique(rows, axis=0, return_inverse=True)
    same = same.reshape(-1)
    order = np.lexsort((ids, same))
    begins = np.concatenate([[True], np.diff(same[order]) != 0])
    rank = np.arange(len(order)) - np.maximum.accumulate(np.where(begins, np.arange(len(order)), 0))
    return np.sort(order[rank < most])


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of paired rows in double precision, components added in order."""
    total = np.zeros(len(left))
    for d in range(left.shape[1]):
        total += left[:, d] * right[:, d]
    return total


def tile_best(
    query_rows: np.ndarray, queries: np.ndarray, numbers: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query place, candidate place, score) of each query's k nearest in the tile; rows are told apart by their numbers."""
    q, c = Quantised(queries), Quantised(rows)
    # sums of int8 products are whole numbers: float32 holds them exactly up to 2**24
    kind = np.float32 if 127 * 127 * rows.shape[1] < 1 << 24 else np.float64
    right = c.int8.astype(kind).T
    out = []
    step = max(1, CELLS // len(ids))
    for low in range(0, len(query_rows), step):
        part = slice(low, low + step)
        about = (q.int8[part].astype(kind) @ right).astype(np.float64) * q.scale[part][:, None] * c.scale
        bound = q.near_norm[part][:, None] * c.error + q.error[part][:, None] * c.norm
        bound += SLACK * q.norm[part][:, None] * c.norm
        own = query_rows[part][:, None] == numbers[None, :]
        lower = np.where(own, -np.inf, about - bound)
        if len(ids) > k:
            least = np.partition(lower, len(ids) - k, axis=1)[:, len(ids) - k]
        else:
            least = np.full(len(lower), -np.inf)
        i, j = np.nonzero((about + bound >= least[:, None]) & ~own)
        score = np.concatenate(
            [products(queries[low + i[s : s + CELLS // 8]], rows[j[s : s + CELLS // 8]]) for s in range(0, max(1, len(i)), CELLS // 8)]
        )
        order = np.lexsort((ids[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        begins = np.searchsorted(i, i, side="left")
        first = np.arange(len(i)) - begins < k
        out.append((i[first] + low, j[first], score[first]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def nearest(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """query_id, rank, vec_id and score of the k largest inner products of every query row."""
    rows = staged(usable(vectors).withColumn("number", F.monotonically_increasing_id()), "vectors")
    rows = rows.withColumn("size", F.size("vector"))
    queries = rows.where(is_query)
    many = rows.count() // CANDIDATE_TILE + 1
    few = queries.count() // QUERY_TILE + 1
    block = lambda salt, n: F.pmod(F.xxhash64(F.lit(salt), "number"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    key = ["size", "qb", "cb"]
    left = queries.withColumn("qb", block(1, few)).withColumn("cb", every(many))
    right = rows.withColumn("cb", block(2, many)).withColumn("qb", every(few))

    def tile(asked: pa.Table, given: pa.Table) -> pa.Table:
        names = ["number", "query_id", "vec_id", "score"]
        if not len(asked) or not len(given):
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.float64())], names=names)
        query_rows, query_ids, queries = asked["number"].to_numpy(), asked["vec_id"].to_numpy(), _matrix(asked["vector"])
        numbers, ids, rows = given["number"].to_numpy(), given["vec_id"].to_numpy(), _matrix(given["vector"])
        few = _few_of_each(ids, rows, k + 1)
        numbers, ids, rows = numbers[few], ids[few], rows[few]
        i, j, score = tile_best(query_rows, queries, numbers, ids, rows, k)
        return pa.table([pa.array(query_rows[i]), pa.array(query_ids[i]), pa.array(ids[j]), pa.array(score)], names=names)

    best = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(tile, "number long, query_id long, vec_id long, score double")
    return best.repartition("number").sortWithinPartitions("number").mapInArrow(
        lambda batches: _merged(batches, k), "query_id long, rank int, vec_id long, score double"
    )


def _merged(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """One heap of at most k entries per query over rows sorted by query."""
    last, name, heap, out = None, None, [], []

    def close() -> None:
        for rank, (score, negative) in enumerate(sorted(heap, reverse=True), 1):
            out.append((name, rank, -negative, score))

    for batch in batches:
        for query, query_id, vec_id, score in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if query != last:
                close()
                last, name, heap = query, query_id, []
            if len(heap) < k:
                heapq.heappush(heap, (score, -vec_id))
            else:
                heapq.heappushpop(heap, (score, -vec_id))
        if len(out) >= 1 << 14:
            yield _ranked(out)
            out = []
    close()
    if out:
        yield _ranked(out)


def _ranked(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.float64()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
        names=["query_id", "rank", "vec_id", "score"],
    )


# Every query against every row.
NEAREST_SQL = """
WITH usable AS (
    SELECT vec_id, embedding AS vector, row_number() OVER () AS number FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), scored AS (
    SELECT q.number, q.vec_id AS query_id, c.vec_id,
           list_inner_product(q.vector::DOUBLE[], c.vector::DOUBLE[]) AS score
    FROM usable q JOIN usable c ON q.number <> c.number AND len(q.vector) = len(c.vector)
    WHERE q.vec_id % 20 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY number ORDER BY score DESC, vec_id) AS place FROM scored
)
SELECT query_id, place::INT AS rank, vec_id, score FROM ranked WHERE place <= 20
"""
