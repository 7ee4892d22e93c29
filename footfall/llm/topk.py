"""Exact top-k by inner product over one KD-tree for each shard of the vectors.

Vectors are dealt into shards by a hash of their id. A shard builds a KD-tree of its distinct
vectors: median splits along the widest dimension, each node with its tight bounding box. A query
visits nodes best first, by the largest inner product that its vector can have with a point of the
box, and stops when no box can reach its kth score. Each query is first searched in one shard; the
kth score found there goes along to the others, where it is the bound from the start.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm import text as T

SCALE = 1024
LEAF = 64
SHARD_ROWS = 20_000
_HITS = "query_id long, vec_id long, score long"


class KDTree:
    """The distinct rows of ``points`` (whole numbers), each with its smallest ids."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, k: int) -> None:
        order = np.lexsort((ids, *points.T[::-1]))
        ids, points = ids[order], points[order]
        new = np.ones(len(ids), bool)
        new[1:] = (points[1:] != points[:-1]).any(axis=1)
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(ids))
        # k + 1 ids of a vector suffice: its smallest ones win ties, one may be the query itself.
        self.ids = [np.unique(ids[a:b])[:k + 1] for a, b in zip(starts, ends, strict=True)]
        self.points = points[starts]
        self.order = np.arange(len(starts))
        self.nodes: list[tuple] = []  # low, high, left, right, first, last
        if len(starts):
            self._split(0, len(starts))

    def _split(self, first: int, last: int) -> int:
        own = self.points[self.order[first:last]]
        low, high = own.min(axis=0), own.max(axis=0)
        at = len(self.nodes)
        self.nodes.append((low, high, -1, -1, first, last))
        if last - first > LEAF:
            half = (last - first) // 2
            part = np.argpartition(own[:, int((high - low).argmax())], half)
            self.order[first:last] = self.order[first:last][part]
            left = self._split(first, first + half)
            right = self._split(first + half, last)
            self.nodes[at] = (low, high, left, right, first, last)
        return at

    @staticmethod
    def _reach(query: np.ndarray, low: np.ndarray, high: np.ndarray) -> int:
        return int(np.maximum(query * low, query * high).sum())

    def search(self, query_id: int, query: np.ndarray, k: int,
               least: int | None) -> list[tuple[int, int]]:
        """Up to k (score, id), best first; scores below ``least`` may be left out."""
        best: list[tuple[int, int]] = []  # a heap of (score, -id): the worst one first
        if not self.nodes:
            return []
        queue = [(-self._reach(query, *self.nodes[0][:2]), 0)]
        while queue:
            reach, at = heapq.heappop(queue)
            bound = best[0][0] if len(best) == k else least
            if bound is not None and -reach < bound:
                break
            low, high, left, right, first, last = self.nodes[at]
            if left >= 0:
                for node in (left, right):
                    heapq.heappush(queue, (-self._reach(query, *self.nodes[node][:2]), node))
                continue
            rows = self.order[first:last]
            scores = self.points[rows] @ query
            if bound is not None:
                keep = scores >= bound
                rows, scores = rows[keep], scores[keep]
            for row, score in zip(rows.tolist(), scores.tolist(), strict=True):
                for vec_id in self.ids[row].tolist():
                    if vec_id == query_id:
                        continue
                    hit = (score, -vec_id)
                    if len(best) < k:
                        heapq.heappush(best, hit)
                    elif hit > best[0]:
                        heapq.heapreplace(best, hit)
        return sorted(((s, -i) for s, i in best), key=lambda h: (-h[0], h[1]))


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """vec_id and floor(1024 * x) of each component; vectors that take no part are left out."""
    x = F.col("embedding").cast("array<double>")
    good = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return (vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
            .where(good)
            .select(F.col("vec_id").cast("long").alias("vec_id"),
                    F.transform(x, lambda c: F.floor(c * SCALE).cast("long")).alias("v")))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _search(shards: DataFrame, tasks: int, k: int) -> DataFrame:
    """Searches each shard for its queries: rows (shard, is_query, vec_id, least, v)."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, ids, points, tree = None, [], [], None
        for batch in batches:
            hits = []
            numbers = batch.column(0).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.diff(numbers)) + 1
            for part in zip([0, *cuts], [*cuts, len(numbers)], strict=True):
                rows = batch.slice(part[0], part[1] - part[0])
                if not rows.num_rows:
                    continue
                if (own := rows.column(0)[0].as_py()) != shard:
                    shard, ids, points, tree = own, [], [], None
                asks = rows.column(1).to_numpy(zero_copy_only=False).astype(bool)
                matrix = _matrix(rows.column(4))
                vec_ids = rows.column(2).to_numpy(zero_copy_only=False)
                if not asks.all():  # a shard's points come before its queries
                    ids.append(vec_ids[~asks])
                    points.append(matrix[~asks])
                if asks.any() and ids:
                    tree = tree or KDTree(np.concatenate(ids), np.concatenate(points), k)
                    least = rows.column(3).to_pylist()
                    for i in np.flatnonzero(asks).tolist():
                        query = int(vec_ids[i])
                        hits += [(query, vec_id, score) for score, vec_id in
                                 tree.search(query, matrix[i], k, least[i])]
            columns = list(zip(*hits, strict=True)) or [()] * 3
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns],
                                  names=["query_id", "vec_id", "score"])

    return (shards.repartitionById(tasks, F.pmod("shard", F.lit(tasks)).cast("int"))
            .sortWithinPartitions("shard", "is_query")
            .select("shard", "is_query", "vec_id", "least", "v").mapInArrow(search, _HITS))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10,
          shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k highest inner products of each query.

    Both frames have vec_id and embedding. Components count as floor(1024 * x); a query's own id
    is no candidate; ties go to the smaller id. Vectors that are null or hold null or non-finite
    components take no part, nor do null ids; vectors of another length than the query's are not
    compared. Repeated rows count once; of two queries with one id the smaller vector is asked.
    Extra columns are ignored. A shard holds at most about ``shard_rows`` vectors. Every query
    meets every shard, so the rows sent are the vectors and the queries times the shards.
    """
    spark = vectors.sparkSession
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    data = whole_numbers(vectors)
    asked = whole_numbers(queries).groupBy("vec_id").agg(F.min("v").alias("v"))
    shards = max(tasks, -(-vectors.count() // shard_rows))
    width = F.size("v")

    def shard(number: Column) -> Column:
        # Vectors of different lengths never share a shard.
        return (width.cast("long") * F.lit(1 << 32) + number).alias("shard")

    home = F.pmod(F.xxhash64("vec_id"), F.lit(shards))
    points = data.select(shard(home), F.lit(False).alias("is_query"), "vec_id",
                         F.lit(None).cast("long").alias("least"), "v")
    first = asked.select(shard(home), F.lit(True).alias("is_query"), "vec_id",
                         F.lit(None).cast("long").alias("least"), "v")
    near = T.written(_search(points.unionByName(first), tasks, k), "topk-first")
    # With k hits the worst of them bounds the query everywhere else.
    bounds = (near.groupBy(F.col("query_id").alias("vec_id"))
              .agg(F.when(F.count("*") >= k, F.min("score")).alias("least")))
    rest = (asked.join(bounds, "vec_id", "left")
            .withColumn("number", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
            .where(F.col("number") != home)
            .select(shard(F.col("number")), F.lit(True).alias("is_query"), "vec_id", "least",
                    "v")) if shards > 1 else None
    hits = near
    if rest is not None:
        hits = near.unionByName(_search(points.unionByName(rest), tasks, k))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
