"""Bounded labelled samples and the hashed terms that tell their classes apart."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm import text as T

Terms = Callable[[str], set[str]]


def labelled(labels: DataFrame, name: str, most: int, training) -> DataFrame:
    """doc_id, y and weight of at most ``most`` rows of each class, by the hash of their id.

    Only rows where the Column ``training`` holds; a null label is none; an id with several labels
    has its largest. ``weight`` restores the classes' shares among all labelled rows.
    """
    known = (labels.where(F.coalesce(training, F.lit(False)) & F.col(name).isin(0, 1))
             .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max(F.col(name).cast("int")).alias("y")))
    counts = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    parts = [known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
             .withColumn("weight", F.lit(counts.get(y, 1) / max(1, min(most, counts.get(y, 1)))))
             for y in (0, 1)]
    return parts[0].unionByName(parts[1])


def texts_of(docs: DataFrame, sample: DataFrame, *columns: str) -> DataFrame:
    """The sample's rows with their texts; ``sample`` is bounded, so it goes to every task.

    Of rows with one id the first in order of their text stays.
    """
    known = T.texts(docs, *columns).join(F.broadcast(sample), "doc_id")
    first = F.min(F.struct("text", *columns, *(c for c in sample.columns if c != "doc_id")))
    return known.groupBy("doc_id").agg(first.alias("r")).select("doc_id", "r.*")


def _hash(term: str) -> int:
    return T.xxhash.xxh3_64_intdigest(term.encode()) >> 1


def telling(sample: DataFrame, terms: Terms, most: int, least: int = 3) -> np.ndarray:
    """Hashes of at most ``most`` terms, in at least ``least`` texts, by how far apart the classes
    are: the difference of their shares over its standard error. ``sample`` has text and y."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: tuple[Counter, Counter] = (Counter(), Counter())

        def flushed() -> pa.RecordBatch:
            keys = list(n[0].keys() | n[1].keys())
            out = pa.record_batch(
                [pa.array([_hash(k) for k in keys], pa.int64()),
                 pa.array([n[0][k] for k in keys], pa.int64()),
                 pa.array([n[1][k] for k in keys], pa.int64())], names=["term", "n0", "n1"])
            n[0].clear()
            n[1].clear()
            return out

        for batch in T.rows(batches, 128):
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                               strict=True):
                n[y].update(terms(text))
            if len(n[0]) + len(n[1]) > 200_000:
                yield flushed()
        yield flushed()

    totals = {r.y: r["count"] for r in sample.groupBy("y").count().collect()}
    a, b = totals.get(0, 0), totals.get(1, 0)
    if not a or not b:
        return np.empty(0, np.int64)
    share = (F.col("n0") + F.col("n1")) / (a + b)
    apart = F.abs(F.col("n1") / b - F.col("n0") / a) / F.sqrt(
        share * (1 - share) * (1 / a + 1 / b) + 1e-9)
    rows = (sample.select("text", "y").mapInArrow(counted, "term long, n0 long, n1 long")
            .groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
            .where(F.col("n0") + F.col("n1") >= least)
            .orderBy(F.desc(F.round(apart, 6)), "term").limit(most).select("term").collect())
    return np.array(sorted(r.term for r in rows), np.int64)


class Index(dict):
    """The numbers of a word's terms among the chosen ones; kept for the words met lately."""

    def __init__(self, chosen: np.ndarray, terms: Terms, most: int = T.KEPT_WORDS) -> None:
        super().__init__()
        self.number = {int(t): i for i, t in enumerate(chosen)}
        self.terms, self.most = terms, most

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= self.most:
            self.clear()
        found = {self.number.get(_hash(t), -1) for t in self.terms(word)}
        value = self[word] = tuple(sorted(found - {-1}))
        return value


class Rows:
    """Sparse binary rows: the numbers of each row's terms, one array after the other."""

    def __init__(self, rows: list[np.ndarray]) -> None:
        self.sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.at = np.concatenate(rows).astype(np.int64) if rows else np.empty(0, np.int64)

    def part(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Term numbers of these rows and the place of each one's row."""
        sizes = self.sizes[rows]
        owner = np.repeat(np.arange(len(rows)), sizes)
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)
        return self.at[np.repeat(self.starts[rows], sizes) + places], owner


def sigmoid(x: np.ndarray | float) -> np.ndarray | float:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


class FactorizationMachine:
    """w0 + sum of w_i + sum over pairs of <v_i, v_j>, over the terms present in a text."""

    def __init__(self, terms: int, factors: int = 8, seed: int = 1) -> None:
        self.w0 = 0.0
        self.w = np.zeros(terms)
        self.v = np.random.default_rng(seed).normal(0, 0.01, (terms, factors))

    def logits(self, at: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Logits of n rows, and the sums of their factors."""
        linear = np.bincount(owner, self.w[at], n)
        sums = np.zeros((n, self.v.shape[1]))
        np.add.at(sums, owner, self.v[at])
        squares = np.bincount(owner, (self.v[at] ** 2).sum(axis=1), n)
        return self.w0 + linear + 0.5 * ((sums ** 2).sum(axis=1) - squares), sums

    def fit(self, rows: Rows, y: np.ndarray, weight: np.ndarray, epochs: int = 20,
            batch: int = 128, rate: float = 0.1, decay: float = 1e-4,
            dropped: float = 0.0) -> FactorizationMachine:
        """Minimises the weighted logistic loss by Adagrad over batches in a fixed random order.

        ``dropped``: share of a row's terms left out at random each time it is seen, so that no
        term is learned only in the company of others.
        """
        rng = np.random.default_rng(0)
        weight = weight / weight.mean()
        share = min(max(float((weight * y).sum() / weight.sum()), 1e-3), 1 - 1e-3)
        self.w0 = math.log(share / (1 - share))
        g0, gw, gv = 1e-8, np.full(len(self.w), 1e-8), np.full(self.v.shape, 1e-8)
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for first in range(0, len(y), batch):
                part = order[first:first + batch]
                at, owner = rows.part(part)
                if dropped:
                    kept = rng.random(len(at)) >= dropped
                    at, owner = at[kept], owner[kept]
                logits, sums = self.logits(at, owner, len(part))
                error = weight[part] * (sigmoid(logits) - y[part]) / len(part)
                own = error[owner]
                step_w = np.bincount(at, own, len(self.w)) + decay * self.w
                step_v = np.zeros_like(self.v)
                np.add.at(step_v, at, own[:, None] * (sums[owner] - self.v[at]))
                step_v += decay * self.v
                step_0 = float(error.sum())
                g0 += step_0 ** 2
                gw += step_w ** 2
                gv += step_v ** 2
                self.w0 -= rate * step_0 / math.sqrt(g0)
                self.w -= rate * step_w / np.sqrt(gw)
                self.v -= rate * step_v / np.sqrt(gv)
        return self

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        sparse = Rows(rows)
        at, owner = sparse.part(np.arange(len(rows)))
        return sigmoid(self.logits(at, owner, len(rows))[0])
