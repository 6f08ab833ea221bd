"""Exact top-k by inner product: candidates in buckets of similar length, pruned by local cosine thresholds.

Candidates are ordered by length over the whole table, longest first, and read in buckets of BUCKET rows.  Queries, a stated
set, come in blocks of BLOCK rows, whose size is bounded and which every task gets.  For a query q with k results so far the
k-th score t must be reached, so a candidate of length l needs a cosine of t / (|q| l) at least:

* a bucket whose longest candidate would need a cosine above 1 holds nothing more for q;
* length pruning: in the bucket only candidates of length t / |q| or more are left, the head of it;
* coordinate pruning: where the needed cosine c is high, a candidate's share in q's largest coordinate must lie within
  the interval that c allows, which leaves few rows.

What is left is verified by exact products.  Thresholds start from the k-th score among a first bucket, the longest candidates.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplake.llm.common import saved
from shoplake.llm.sharding import numbered

# Rows of a bucket, and queries of a block: a block of 1,000 coordinates takes 64 MB at most.
BUCKET = 2048
BLOCK = 8192
# Coordinate pruning pays above this needed cosine; rounding errors of lengths and cosines are far below SLACK.
HIGH = 0.9
SLACK = 1e-6
# Products and sums below this are exact in double precision.
EXACT = float(1 << 53)


def whole_numbers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component; null if the vector or a component is null or not finite."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    good = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.when(good, F.transform(wide, lambda x: F.floor(x * scale)))


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Vectors of `width` coordinates, short ones filled with zeros."""
    n, flat, cuts = len(column), column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
    out = np.zeros((n, width), np.int64)
    out[np.arange(width) < cuts[:, None]] = flat
    return out


def _norms(rows: np.ndarray) -> np.ndarray:
    return np.sqrt((rows.astype(np.float64) ** 2).sum(axis=1))


class _Best:
    """The k best of every query of a block; ties go to the smaller id."""

    def __init__(self, queries: np.ndarray, ids: np.ndarray, k: int, floor: np.ndarray | None):
        self.q, self.ids, self.k = queries, ids, k
        self.length = _norms(queries)
        self.wide = queries.astype(np.float64)
        self.top = np.argmax(np.abs(queries), axis=1) if queries.shape[1] else np.zeros(len(ids), int)
        self.share = self.wide[np.arange(len(ids)), self.top] / np.maximum(self.length, 1e-300) if queries.shape[1] else self.length
        self.bar = np.full(len(ids), np.iinfo(np.int64).min) if floor is None else floor.copy()
        self.need = self.bar.astype(np.float64)  # for pruning, where a rounding error is within SLACK
        self.found: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in ids]
        self.held = np.zeros(len(ids), np.int64)

    def add(self, rows: np.ndarray, ids: np.ndarray) -> None:
        """A bucket, in any order of its rows."""
        lengths = _norms(rows)
        order = np.argsort(-lengths, kind="stable")
        rows, ids, lengths = rows[order], ids[order], lengths[order]
        longest = lengths[0]
        reach = self.length * longest
        active = np.flatnonzero(reach * (1 + SLACK) + SLACK >= self.need)
        if not len(active):
            return
        exact = float(self.length[active].max()) * float(longest) < EXACT
        wide = rows.astype(np.float64) if exact else None
        high = self.need[active] > HIGH * reach[active]
        dense = active[~high]
        for some in np.array_split(dense, -(-len(dense) // 512)) if len(dense) else []:
            scores = (self.wide[some] @ wide.T).astype(np.int64) if exact else self.q[some] @ rows.T
            for q, line in zip(some, scores):
                self._keep(q, line, ids)
        for q in active[high]:
            last = np.searchsorted(-lengths, -(self.need[q] / self.length[q]) * (1 - SLACK) + SLACK, "right")
            # Angles: a candidate within `wide_of` of q is at angle `own` +- `wide_of` from q's largest coordinate.
            wide_of = np.arccos(min(1.0, self.need[q] / (self.length[q] * longest)))
            own = np.arccos(np.clip(self.share[q], -1, 1))
            least, most = np.cos(min(np.pi, own + wide_of)), np.cos(max(0.0, own - wide_of))
            share = rows[:last, self.top[q]] / np.maximum(lengths[:last], 1e-300)
            rest = np.flatnonzero((share >= least - SLACK) & (share <= most + SLACK))
            if len(rest):
                scores = (wide[rest] @ self.wide[q]).astype(np.int64) if exact else rows[rest] @ self.q[q]
                self._keep(q, scores, ids[rest])

    def _keep(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        good = (scores >= self.bar[q]) & (ids != self.ids[q])
        if not good.any():
            return
        scores, ids = scores[good], ids[good]
        if len(ids) > self.k:
            cut = np.partition(scores, -self.k)[-self.k]
            scores, ids = scores[scores >= cut], ids[scores >= cut]
        self.found[q].append((scores, ids))
        self.held[q] += len(ids)
        if self.held[q] >= self.k:
            scores, ids = self.result(q)
            self.found[q], self.held[q] = [(scores, ids)], len(ids)
            if len(ids) == self.k:
                self.bar[q] = max(self.bar[q], scores[-1])
                self.need[q] = self.bar[q]

    def result(self, q: int) -> tuple[np.ndarray, np.ndarray]:
        scores = np.concatenate([s for s, _ in self.found[q]])
        ids = np.concatenate([i for _, i in self.found[q]])
        order = np.lexsort((ids, -scores))[: self.k]
        return scores[order], ids[order]

    def batch(self) -> pa.RecordBatch:
        lines = [(self.ids[q], *self.result(q)) for q in range(len(self.ids)) if self.found[q]]
        parts = [np.repeat([i for i, _, _ in lines], [len(s) for _, s, _ in lines])] if lines else [np.zeros(0, np.int64)]
        for c in (2, 1):
            parts.append(np.concatenate([x[c] for x in lines]) if lines else np.zeros(0, np.int64))
        return pa.RecordBatch.from_arrays([pa.array(p, pa.int64()) for p in parts], ["query_id", "vec_id", "score"])


def _searched(candidates: DataFrame, queries: np.ndarray, ids: np.ndarray, k: int, floor: np.ndarray | None) -> DataFrame:
    """The k best of every query in each task's candidates, and no others that cannot be among the k best of all."""
    sc, width = candidates.sparkSession.sparkContext, queries.shape[1]
    sent = sc.broadcast((queries, ids, floor))

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(*sent.value[:2], k, sent.value[2])
        for b in batches:
            for at in range(0, b.num_rows, BUCKET):
                part = b.slice(at, BUCKET)
                best.add(_matrix(part.column(1), width), part.column(0).to_numpy())
        yield best.batch()

    return candidates.select("vec_id", "v").mapInArrow(search, "query_id long, vec_id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    scale: int = 64,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block: int = BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id and score of the k highest inner products of each query, all rows but its own being candidates.

    Ties go to the smaller id.  Rows take no part if their id or vector is null or a component is null or not finite; vectors
    of fewer components are filled with zeros.  Rows that repeat an id are candidates of their own, and the queries among
    them are answered once, by the first in the order of their vectors.  `is_query` is a condition on `vec_id`.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), whole_numbers(F.col(vector_col), scale).alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    length = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    order = [F.desc("length"), "vec_id"]
    ranged = rows.withColumn("length", length).repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = saved(ranged.withColumn("part", F.spark_partition_id()), "vectors")
    width = ranged.agg(F.max(F.size("v"))).first()[0] or 0
    asked = ranged.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    first = ranged.agg(F.min("part")).first()[0] or 0  # the parts follow the order
    head = ranged.where(F.col("part") == first).orderBy(*order).select("vec_id", "v").limit(BUCKET)
    head = saved(head, "head")
    asked, n = numbered(asked, ["vec_id"])
    out: DataFrame | None = None
    for first in range(0, n, block):
        some = asked.where(F.col("number").between(first, first + block - 1)).select("vec_id", "v").toArrow()
        ids = some.column(0).to_numpy()
        queries = np.concatenate([_matrix(c, width) for c in some.column(1).chunks]) if len(ids) else np.zeros((0, width), np.int64)
        floor = np.full(len(ids), np.iinfo(np.int64).min)
        least = _ranked(_searched(head, queries, ids, k, None), k).where(F.col("rank") == k).select("query_id", "score")
        at = {q: i for i, q in enumerate(ids)}
        for q, score in least.collect():
            floor[at[q]] = score
        found = saved(_ranked(_searched(ranged, queries, ids, k, floor), k), "found")
        out = found if out is None else out.unionAll(found)
    if out is None:
        out = _ranked(ranged.select(F.col("vec_id").alias("query_id"), "vec_id", F.lit(0).cast("long").alias("score")).limit(0), k)
    return out.select("query_id", "rank", "vec_id", "score")
