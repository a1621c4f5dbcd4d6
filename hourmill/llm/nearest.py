"""Nearest neighbours by a block matrix join with int8 tiles.

Queries and candidates come in blocks; every pair of a query group and a candidate
group is one key, so work spreads over the grid and no group outgrows its block. In
a tile the int8 product gives every distance with a bound on its error (each
vector's exact distance to its rounded self). Only pairs whose least possible
distance is within a query's present k-th best are computed again in double
precision, so the result is exact. Each tile's best go into a heap per query.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import table_of

QUERY_GROUP, CANDIDATE_GROUP, TILE = 1024, 32_768, 1024

_BEST = "query_id long, vec_id long, score double"
_BEST_ARROW = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def rounded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 vectors, their scales, and each one's distance to its original."""
    scale = np.abs(x).max(axis=1) / 127
    scale[scale == 0] = 1
    q = np.rint(x / scale[:, None]).astype(np.int8)
    return q, scale, np.linalg.norm(x - q * scale[:, None], axis=1)


class Best:
    """The k nearest so far of each query, as heaps of (-distance, -vec_id)."""

    def __init__(self, k: int, n: int):
        self.k, self.heaps = k, [[] for _ in range(n)]

    def limit(self, i: int) -> float:
        return -self.heaps[i][0][0] if len(self.heaps[i]) == self.k else np.inf

    def add(self, i: int, distances: np.ndarray, ids: np.ndarray) -> None:
        heap = self.heaps[i]
        for d, v in zip(distances.tolist(), ids.tolist()):
            if len(heap) < self.k:
                heapq.heappush(heap, (-d, -v))
            elif (-d, -v) > heap[0]:
                heapq.heapreplace(heap, (-d, -v))


def tile(best: Best, ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, rounded_queries) -> None:
    """Bring the candidates ``ids``, ``x`` into the queries' heaps."""
    q, scale, error = rounded(x)
    rq, rscale, rerror = rounded_queries
    exact = np.float32 if 127 * 127 * q.shape[1] < 1 << 24 else np.float64  # holds the integer products as they are
    a, b = rq.astype(exact), q.astype(exact)
    own = (a * a).sum(axis=1, dtype=np.float64) * rscale**2
    other = (b * b).sum(axis=1, dtype=np.float64) * scale**2
    squared = own[:, None] + other[None, :] - 2.0 * (a @ b.T) * rscale[:, None] * scale[None, :]
    about = np.sqrt(np.maximum(squared, 0))
    slack = rerror[:, None] + error[None, :]
    slack += 1e-6 * (1 + np.linalg.norm(queries, axis=1)[:, None] + np.linalg.norm(x, axis=1)[None, :])
    mine = ids[None, :] == query_ids[:, None]
    low, high = about - slack, np.where(mine, np.inf, about + slack)
    kth = np.partition(high, best.k - 1, axis=1)[:, best.k - 1] if high.shape[1] >= best.k else np.full(len(queries), np.inf)
    for i in range(len(queries)):
        near = np.flatnonzero((low[i] <= min(best.limit(i), kth[i])) & ~mine[i])
        if len(near):
            squares = np.cumsum((x[near] - queries[i]) ** 2, axis=1)[:, -1]  # added up in order
            best.add(i, np.sqrt(squares), ids[near])


def _join(k: int):
    def vectors(rows: list) -> np.ndarray:
        return np.array(rows, np.float64)

    def results(query_ids: np.ndarray, best: Best) -> pa.RecordBatch:
        out = [(q, -v, -d) for q, heap in zip(query_ids.tolist(), best.heaps) for d, v in heap]
        return table_of(dict(zip(_BEST_ARROW.names, zip(*out) if out else ([], [], []))), _BEST_ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, best, group, held = None, None, None, None
        ids: list[int] = []
        rows: list[list[float]] = []
        asked: list[int] = []
        asked_rows: list[list[float]] = []

        def flush():
            nonlocal best, group, held, ids, rows
            if rows and asked:
                if best is None:
                    group, best = vectors(asked_rows), Best(k, len(asked))
                    held = rounded(group)
                tile(best, np.array(ids, np.int64), vectors(rows), np.array(asked, np.int64), group, held)
            ids, rows = [], []

        for batch in batches:
            for key, kind, vec_id, vector in zip(*[c.to_pylist() for c in batch.columns]):
                if key != now:
                    flush()
                    if best is not None:
                        yield results(np.array(asked, np.int64), best)
                    now, best, asked, asked_rows = key, None, [], []
                if kind == 0:
                    asked.append(vec_id), asked_rows.append(vector)
                else:
                    ids.append(vec_id), rows.append(vector)
                    if len(ids) == TILE:
                        flush()
        flush()
        if best is not None:
            yield results(np.array(asked, np.int64), best)

    return run


def usable(vector: Column) -> Column:
    """Whether a vector has finite components only, not all of them zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` nearest vectors of each query by Euclidean distance.

    Both tables have ``vec_id`` and ``embedding``; rows of a query's own number are
    not its candidates. Columns: ``query_id``, ``rank`` (from 1), ``vec_id``,
    ``score``. Equal distances go by smaller ``vec_id``. Vectors that are null, empty,
    zero or hold null or non-finite components take no part, nor do rows without
    number; vectors of another length are not compared. Wholly equal rows count once.
    Extra columns are not carried; an empty table on either side gives no rows.
    """

    def prepared(df: DataFrame) -> DataFrame:
        rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
        return rows.where(F.col("vec_id").isNotNull() & usable(F.col("v"))).distinct()

    candidates, asked = prepared(vectors), prepared(queries)

    def groups(df: DataFrame, size: int) -> int:
        return max(1, -(-df.count() // size))

    n_candidates, n_queries = groups(candidates, CANDIDATE_GROUP), groups(asked, QUERY_GROUP)
    n_candidates = max(n_candidates, min(32, groups(candidates, TILE)))

    def grid(df: DataFrame, kind: int, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        home = F.pmod(F.xxhash64("vec_id", "v"), F.lit(n_own)).alias(own)
        spread = df.select("*", home, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))).alias(other))
        key = (F.col("cg").cast("long") * n_queries + F.col("qg")) * 65_536 + F.size("v")
        return spread.select(key.alias("key"), F.lit(kind).alias("kind"), "vec_id", "v")

    both = grid(asked, 0, "qg", n_queries, "cg", n_candidates).unionByName(
        grid(candidates, 1, "cg", n_candidates, "qg", n_queries)
    )
    found = both.repartition("key").sortWithinPartitions("key", "kind", "vec_id").mapInArrow(_join(k), _BEST)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
