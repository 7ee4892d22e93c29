"""Nearest neighbours by inner product over vantage-point trees, one for each shard of the vectors.

Largest inner product is turned into smallest distance: a vector divided by the greatest length of
all gets one more component that makes its length 1, and a query is taken at length 1 with that
component 0. The squared distance is then 2 less twice the scaled inner product.

The top levels are one vantage-point tree fitted on a bounded sample; every row goes down it to its
shard, and a shard knows the least and greatest distance of all its rows to each vantage point on
its path. Each shard, cut by a hash of the id where it is large, has a tree of its own. For a query
at distance d from a vantage point, what lies between the distances a and b from it is at least
max(a - d, d - b) away. A shard or subtree is left out if ``factor`` times that bound is beyond the
kth distance found so far: factor 1 gives the exact answer, larger factors search less. How large it
may be depends on how the vectors lie, so it is tried out on the sample.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm import text as T

FACTORS = (4.0, 3.0, 2.0, 1.5, 1.2)  # tried out, from the fastest
RECALL = 0.98  # of a factor on the sample
TRIED = 64  # sampled rows that are asked for it
LEAF = 64
SHARD_ROWS = 8192
LEAST_ROWS = 512  # of a shard on average: fewer bound a query's kth distance badly
SAMPLE_ROWS = 16_384
SAMPLE_LEAF = 16  # sampled rows of a shard at least
ASKED = 256  # queries that a tree is asked at a time
SLACK = 1e-9  # of a distance, for rounding
_HITS = "query_id long, vec_id long, score double"


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances between all rows of two arrays of vectors of length 1."""
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


def _on_sphere(vectors: np.ndarray, longest: float) -> np.ndarray:
    scaled = vectors / longest
    rest = np.sqrt(np.maximum(1 - (scaled * scaled).sum(axis=1), 0))
    return np.column_stack([scaled, rest])


def _asked(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    scaled /= np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))
    return np.column_stack([scaled, np.zeros(len(vectors))])


class VantageTree:
    """Median splits of rows of length 1 by their distance to one of them."""

    def __init__(self, points: np.ndarray, leaf: int) -> None:
        self.leaf = leaf
        self.order = np.arange(len(points))
        self.nodes: list[tuple] = []  # vantage point or -1, radius, left, right, first, last
        self.shells: list[tuple[float, float]] = []  # distances to the parent's vantage point
        vantages: list[np.ndarray] = []
        self._split(points, vantages, 0, len(points), (0.0, 2.0))
        self.vantages = np.array(vantages).reshape(len(vantages), points.shape[1])

    def _split(self, points, vantages, first: int, last: int, shell: tuple[float, float]) -> int:
        at = len(self.nodes)
        self.nodes.append((-1, 0.0, -1, -1, first, last))
        self.shells.append(shell)
        if last - first <= self.leaf:
            return at
        rows = self.order[first:last]
        # Of a few rows the one whose distances to others differ most.
        few = points[rows[np.linspace(0, len(rows) - 1, 5).astype(int)]]
        some = points[rows[np.linspace(0, len(rows) - 1, min(len(rows), 100)).astype(int)]]
        vantage = few[_apart(few, some).std(axis=1).argmax()]
        away = _apart(points[rows], vantage[None])[:, 0]
        half = len(rows) // 2
        part = np.argpartition(away, half)
        self.order[first:last], away = rows[part], away[part]
        number = len(vantages)
        vantages.append(vantage)
        left = self._split(points, vantages, first, first + half,
                           (away[:half].min(), away[:half].max()))
        right = self._split(points, vantages, first + half, last,
                            (away[half:].min(), away[half:].max()))
        self.nodes[at] = (number, float(away[half]), left, right, first, last)
        return at

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """For each node and query the distance that every row of the node keeps at least."""
        away = _apart(self.vantages, queries)
        out = np.zeros((len(self.nodes), len(queries)))
        for at, (vantage, _, left, right, _, _) in enumerate(self.nodes):
            for child in (left, right) if vantage >= 0 else ():
                low, high = self.shells[child]
                np.maximum(out[at], low - away[vantage], out=out[child])
                np.maximum(out[child], away[vantage] - high, out=out[child])
        return out


class Shards:
    """The top levels: which shard a vector belongs to, and how near a shard can be to a query."""

    def __init__(self, sample: np.ndarray, most: int) -> None:
        leaf = max(SAMPLE_LEAF, -(-len(sample) // most))
        self.tree = VantageTree(sample, leaf)
        self.tree.order = None
        self.paths: dict[int, list[int]] = {}  # shard (a leaf): vantage points from the top
        self._walk(0, [])
        self.ranges: dict[int, list[tuple[float, float]]] = {}

    def _walk(self, at: int, path: list[int]) -> None:
        vantage, _, left, right, _, _ = self.tree.nodes[at]
        if vantage < 0:
            self.paths[at] = path
        else:
            self._walk(left, [*path, vantage])
            self._walk(right, [*path, vantage])

    def place(self, points: np.ndarray) -> tuple[np.ndarray, list[list[float]]]:
        """Each row's shard, and its distances to the vantage points on its path."""
        shard = np.zeros(len(points), np.int64)
        away = _apart(points, self.tree.vantages) if len(self.tree.vantages) else None
        for at, (vantage, radius, left, right, _, _) in enumerate(self.tree.nodes):
            if vantage >= 0:  # children have higher numbers
                here = np.flatnonzero(shard == at)
                shard[here] = np.where(away[here, vantage] < radius, left, right)
        return shard, [away[i, self.paths[s]].tolist() if self.paths[s] else []
                       for i, s in enumerate(shard.tolist())]

    def bounds(self, queries: np.ndarray) -> dict[int, np.ndarray]:
        """For each shard that has rows the least distance that they keep to each query."""
        away = _apart(self.tree.vantages, queries) if len(self.tree.vantages) else None
        out = {}
        for shard, ranges in self.ranges.items():
            least = np.zeros(len(queries))
            for vantage, (low, high) in zip(self.paths[shard], ranges, strict=True):
                np.maximum(least, low - away[vantage], out=least)
                np.maximum(least, away[vantage] - high, out=least)
            out[shard] = least
        return out


class _Index:
    """The vectors of one part of a shard, each distinct one with its smallest ids."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, longest: float) -> None:
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], np.ascontiguousarray(vectors[order])
        as_bytes = vectors.view(f"V{vectors.dtype.itemsize * vectors.shape[1]}")[:, 0]
        _, first, which = np.unique(as_bytes, return_index=True, return_inverse=True)
        groups = np.split(np.argsort(which, kind="stable"), np.cumsum(np.bincount(which))[:-1])
        # k + 1 ids suffice: smaller ones win ties, one may be the query itself.
        self.ids = [np.unique(ids[g])[:k + 1] for g in groups]
        self.tree = VantageTree(_on_sphere(vectors[first], longest), LEAF)
        self.vectors = vectors[first][self.tree.order]
        self.leaves = np.array([at for at, node in enumerate(self.tree.nodes) if node[0] < 0])
        self.k, self.longest = k, longest

    def search(self, ids: list[int], queries: np.ndarray, least: list[float | None],
               factor: float) -> Iterator[tuple[int, int, float]]:
        """(query, id, score): up to k for each query; scores below ``least`` may be missing."""
        bounds = self.tree.bounds(_asked(queries))[self.leaves] * factor
        order = np.argsort(bounds, axis=0, kind="stable")
        lengths = np.sqrt((queries * queries).sum(axis=1)) * self.longest
        for i, query_id in enumerate(ids):
            scores, rows = np.empty(0), np.empty(0, np.int64)
            worst = least[i]
            for at in order[:, i].tolist():
                if worst is not None:
                    reach = np.sqrt(max(2 - 2 * worst / lengths[i], 0)) + SLACK
                    if bounds[at, i] > reach:
                        break
                _, _, _, _, first, last = self.tree.nodes[self.leaves[at]]
                # Row by row, so that equal vectors have equal scores.
                found = (self.vectors[first:last] * queries[i]).sum(axis=1)
                own = np.arange(first, last)
                if worst is not None:
                    keep = found >= worst
                    found, own = found[keep], own[keep]
                if not len(found):
                    continue
                scores, rows = np.concatenate([scores, found]), np.concatenate([rows, own])
                if len(scores) > self.k:  # one row of them may be the query itself
                    kth = np.partition(scores, len(scores) - self.k - 1)[len(scores) - self.k - 1]
                    keep = scores >= kth
                    scores, rows = scores[keep], rows[keep]
                    worst = kth if worst is None else max(worst, kth)
            hits = [(-score, vec_id) for score, row in zip(scores.tolist(), rows.tolist(), strict=True)
                    for vec_id in self.ids[self.tree.order[row]].tolist() if vec_id != query_id]
            yield from ((query_id, vec_id, -score) for score, vec_id in sorted(hits)[:self.k])


def taking_part(vectors: DataFrame) -> DataFrame:
    """vec_id, v, length: vectors without null or non-finite components, other than zero."""
    x = F.col("embedding").cast("array<double>")
    good = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    most = F.array_max(F.transform("v", lambda c: F.abs(c)))
    squares = F.aggregate("v", F.lit(0.0), lambda s, c: s + (c / F.col("most")) ** 2)
    return (vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
            .where(good).select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("v"))
            .withColumn("most", most).where(F.col("most") > 0)
            .select("vec_id", "v", (F.col("most") * F.sqrt(squares)).alias("length")))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _same_width(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The batches cut into rows whose vectors have one length."""
    for batch in batches:
        widths = batch.column(column).value_lengths().to_numpy(zero_copy_only=False)
        for width in np.unique(widths):
            yield batch.filter(pa.array(widths == width))


def _sampled(data: DataFrame, rows: int, sample_rows: int) -> dict[int, np.ndarray]:
    """At most about ``sample_rows`` rows by a hash of the id, by their length."""
    share = min(1.0, sample_rows / max(rows, 1))
    few = data.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < round(share * (1 << 20)))
    by_width: dict[int, list] = {}
    for row in few.select("v").distinct().limit(2 * sample_rows).toLocalIterator():
        by_width.setdefault(len(row.v), []).append(row.v)
    return {width: np.array(sorted(own)) for width, own in by_width.items()}


def tuned(sample: np.ndarray, k: int, longest: float) -> float:
    """The largest of FACTORS that finds nearly all of what factor 1 finds among the sample."""
    index = _Index(np.arange(len(sample)), sample, k, longest)
    asked = np.unique(np.linspace(0, len(sample) - 1, TRIED).astype(int))

    def found(factor: float) -> set[tuple[int, int]]:
        return {hit[:2] for hit in index.search(asked.tolist(), sample[asked],
                                                [None] * len(asked), factor)}

    exact = found(1.0)
    for factor in FACTORS:
        if len(found(factor) & exact) >= RECALL * len(exact):
            return factor
    return 1.0


def _placed(data: DataFrame, tops: dict[int, Shards], longest: float) -> DataFrame:
    schema = "width int, shard long, vec_id long, away array<double>, v array<double>"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _same_width(batches, "v"):
            vectors = _matrix(batch.column("v"))
            shard, away = np.zeros(len(vectors), np.int64), [[]] * len(vectors)
            if top := tops.get(vectors.shape[1]):
                shard, away = top.place(_on_sphere(vectors, longest))
            yield pa.record_batch(
                [pa.array([vectors.shape[1]] * len(vectors), pa.int32()), pa.array(shard),
                 batch.column("vec_id"), pa.array(away, pa.list_(pa.float64())),
                 batch.column("v")],
                names=["width", "shard", "vec_id", "away", "v"])

    return data.select("vec_id", "v").mapInArrow(place, schema)


def _measured(placed: DataFrame, tops: dict[int, Shards]) -> dict[tuple[int, int], int]:
    """Sets each shard's distance ranges from all its rows; returns how many it has.

    One row for each shard comes to the driver, as many as the sample allows.
    """
    deepest = max((len(p) for top in tops.values() for p in top.paths.values()), default=0)
    known = placed.where(F.col("width").isin(*tops)) if tops else placed.limit(0)
    stats = known.groupBy("width", "shard").agg(
        F.count("*").alias("n"),
        *[f(F.get("away", F.lit(i))).alias(f"{name}{i}") for i in range(deepest)
          for name, f in (("low", F.min), ("high", F.max))])
    sizes = {}
    for row in stats.toLocalIterator():
        top = tops[row.width]
        top.ranges[row.shard] = [(row[f"low{i}"], row[f"high{i}"])
                                 for i in range(len(top.paths[row.shard]))]
        sizes[row.width, row.shard] = row.n
    return sizes


def _sent(asked: DataFrame, tops: dict[int, Shards], parts: dict[tuple, int], longest: float,
          factor: float, home: bool) -> DataFrame:
    """Queries (vec_id, v, least) to the shard nearest by its bound, or to the others in reach."""
    schema = "width int, shard long, part int, vec_id long, least double, v array<double>"

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _same_width(T.rows(batches), "v"):
            vectors = _matrix(batch.column("v"))
            width = vectors.shape[1]
            least = batch.column("least").to_numpy(zero_copy_only=False).astype(float)
            top = tops.get(width)
            bounds = top.bounds(_asked(vectors)) if top else {0: np.zeros(len(vectors))}
            if not bounds:
                continue
            shards = np.array(list(bounds))
            matrix = np.array(list(bounds.values()))
            nearest = matrix.argmin(axis=0)
            lengths = np.sqrt((vectors * vectors).sum(axis=1)) * longest
            reach = np.sqrt(np.maximum(2 - 2 * least / lengths, 0)) + SLACK
            for number, shard in enumerate(shards.tolist()):
                if home:
                    go = nearest == number
                else:
                    go = (nearest != number) & (np.isnan(least) | (factor * matrix[number] <= reach))
                rows = batch.filter(pa.array(go))
                for part in range(parts.get((width, shard), 1) if rows.num_rows else 0):
                    yield pa.record_batch(
                        [pa.array([width] * rows.num_rows, pa.int32()),
                         pa.array([shard] * rows.num_rows, pa.int64()),
                         pa.array([part] * rows.num_rows, pa.int32()), rows.column("vec_id"),
                         rows.column("least"), rows.column("v")],
                        names=["width", "shard", "part", "vec_id", "least", "v"])

    return asked.select("vec_id", "v", "least").mapInArrow(send, schema)


def _searched(points: DataFrame, sent: DataFrame, k: int, longest: float,
              factor: float) -> DataFrame:
    """Builds the tree of each part from its points and asks it the queries sent there."""
    keys = ("width", "shard", "part")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, vectors, index = None, [], [], None
        for batch in batches:
            own = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)])
            cuts = np.flatnonzero((own[:, 1:] != own[:, :-1]).any(axis=0)) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if a == b:
                    continue
                rows = batch.slice(a, b - a)
                if tuple(own[:, a]) != key:
                    key, ids, vectors, index = tuple(own[:, a]), [], [], None
                asks = rows.column("is_query").to_numpy(zero_copy_only=False).astype(bool)
                vec_ids = rows.column("vec_id").to_numpy(zero_copy_only=False)
                matrix = _matrix(rows.column("v"))
                if not asks.all():  # a part's points come before its queries
                    ids.append(vec_ids[~asks])
                    vectors.append(matrix[~asks])
                if not asks.any() or not ids:
                    continue
                index = index or _Index(np.concatenate(ids), np.concatenate(vectors), k, longest)
                least = rows.column("least").to_pylist()
                at = np.flatnonzero(asks)
                for some in np.split(at, range(ASKED, len(at), ASKED)):
                    hits = list(index.search(vec_ids[some].tolist(), matrix[some],
                                             [least[i] for i in some], factor))
                    columns = list(zip(*hits, strict=True)) or [()] * 3
                    yield pa.record_batch(
                        [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                         pa.array(columns[2], pa.float64())],
                        names=["query_id", "vec_id", "score"])

    rows = (points.select(*keys, F.lit(False).alias("is_query"), "vec_id",
                          F.lit(None).cast("double").alias("least"), "v")
            .unionByName(sent.select(*keys, F.lit(True).alias("is_query"), "vec_id", "least", "v")))
    return (rows.repartition(*keys).sortWithinPartitions(*keys, "is_query")
            .mapInArrow(search, _HITS))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, factor: float | None = None,
            shard_rows: int = SHARD_ROWS, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: k vectors of nearly the largest inner products.

    Both frames have vec_id and embedding. Scores are inner products of the vectors as they are, in
    double precision; ties go to the smaller id; a query's own id is no candidate. With ``factor`` 1
    the answer is exact; without a factor it is :func:`tuned` on the sample. Vectors that are null, zero or hold null or non-finite components take no
    part, nor do null ids; vectors of another length than the query's are not compared. Repeated
    rows count once; of two queries with one id the smaller vector is asked. Extra columns are
    ignored; an empty table gives no rows. At most about ``sample_rows`` vectors come to the driver,
    to fit the top levels; every row is indexed. A part holds at most about ``shard_rows`` rows.
    """
    spark = vectors.sparkSession
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    data = taking_part(vectors)
    rows, longest = data.agg(F.count("*"), F.max("length")).first()
    if not rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    samples = _sampled(data, rows, sample_rows)
    shards = max(1, min(tasks, rows // LEAST_ROWS), -(-rows // shard_rows))
    tops = {width: Shards(_on_sphere(own, longest), shards)
            for width, own in samples.items()}
    if factor is None:
        factor = tuned(max(samples.values(), key=len), k, longest) if samples else 1.0
    placed = T.written(_placed(data, tops, longest), "vantage-points")
    sizes = _measured(placed, tops)
    parts = {at: -(-n // shard_rows) for at, n in sizes.items() if n > shard_rows}
    # One row for each large shard: never more than the sample has leaves.
    cuts = spark.createDataFrame([(*at, n) for at, n in parts.items()],
                                 "width int, shard long, parts int")
    number = F.pmod(F.xxhash64("vec_id"), F.coalesce("parts", F.lit(1)))
    points = (placed.join(F.broadcast(cuts), ["width", "shard"], "left")
              .withColumn("part", number.cast("int")))
    asked = (taking_part(queries).groupBy("vec_id").agg(F.min("v").alias("v")))
    first = _sent(asked.withColumn("least", F.lit(None).cast("double")), tops, parts, longest,
                  factor, home=True)
    near = T.written(_searched(points, first, k, longest, factor), "vantage-first")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # With k hits the worst of the best k bounds the query everywhere else.
    bounds = (near.withColumn("at", F.row_number().over(best)).where(F.col("at") == k)
              .select(F.col("query_id").alias("vec_id"), F.col("score").alias("least")))
    rest = _sent(asked.join(bounds, "vec_id", "left"), tops, parts, longest, factor, home=False)
    hits = near.unionByName(_searched(points, rest, k, longest, factor))
    return (hits.distinct().withColumn("rank", F.row_number().over(best))
            .where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
