from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from footfall.llm import queries, vantage
from tests.llm.conftest import SMALL

SCHEMA = "vec_id long, embedding array<double>, label int, v string, least string"


def _run(spark, rows, k=20, **more):
    vectors = spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows], SCHEMA)
    got = vantage.nearest(vectors, vectors.where("vec_id % 20 = 0"), k, **more).collect()
    return sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in got)


def _by_hand(rows, k=20):
    good = {i: np.array(v) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = []
    for q in good:
        if q % 20 == 0:
            hits = sorted((-float((good[q] * good[i]).sum()), i) for i in good
                          if i != q and len(good[i]) == len(good[q]))[:k]
            out += [(q, n + 1, i, round(-s, 9)) for n, (s, i) in enumerate(hits)]
    return sorted(out)


def _clusters(seed, n, width=8, lengths=False):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (12, width))
    points = centres[rng.integers(0, 12, n)] + rng.normal(0, 0.05, (n, width))
    if lengths:
        points *= rng.gamma(2, 1, (n, 1))
    return [(i, p.tolist()) for i, p in enumerate(points)]


@pytest.mark.parametrize("lengths", [False, True])
def test_factor_is_tuned_to_the_vectors(spark, lengths):
    rows = _clusters(9, 2000, width=16, lengths=lengths)
    exact = {r[:1] + r[2:3] for r in _by_hand(rows)}
    got = {r[:1] + r[2:3] for r in _run(spark, rows, shard_rows=200)}
    assert len(got & exact) >= 0.9 * len(exact)
    even = np.array([v for _, v in _clusters(9, 500, width=3)])
    assert vantage.tuned(even, 5, float(np.linalg.norm(even, axis=1).max())) in (
        *vantage.FACTORS, 1.0)


@pytest.mark.parametrize("lengths", [False, True])
@pytest.mark.parametrize("shard_rows", [40, 5000])
def test_factor_one_is_exact(spark, shard_rows, lengths):
    rows = _clusters(1, 800, lengths=lengths)
    assert _run(spark, rows, factor=1, shard_rows=shard_rows) == _by_hand(rows)


def test_recall_of_the_query(spark):
    got = queries.op12_vantage_points(spark, SMALL).collect()
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in
            spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    want = _by_hand(rows)
    assert len(got) == len(want)
    hits = {(q, i) for q, _, i, _ in want} & {(r.query_id, r.vec_id) for r in got}
    assert len(hits) >= 0.9 * len(want)
    vectors = dict(rows)
    for r in got:
        exact = sum(a * b for a, b in zip(vectors[r.query_id], vectors[r.vec_id], strict=True))
        assert abs(r.score - exact) < 1e-12


def test_queries_go_to_shards_in_reach(spark, monkeypatch):
    rows = _clusters(3, 3000, width=16)
    rows = [(i, (np.array(v) / np.linalg.norm(v)).tolist()) for i, v in rows]
    exact = {r[:1] + r[2:3] for r in _by_hand(rows)}
    sent = {}
    searched = vantage._searched
    for factor in (1, None):
        counts = []
        monkeypatch.setattr(vantage, "_searched", lambda points, asked, *more, counts=counts: (
            counts.append(asked.count()) or searched(points, asked, *more)))
        got = {r[:1] + r[2:3] for r in _run(spark, rows, factor=factor, shard_rows=100)}
        assert len(got & exact) >= (1 if factor == 1 else 0.9) * len(exact)
        sent[factor] = sum(counts)
    shards = 30
    assert sent[None] <= sent[1] < 150 * shards  # queries times shards


def test_large_shards_are_cut(spark):
    same = [0.25, -0.5, 1.0]
    rows = [(i, same) for i in range(900)] + [(900 + i, [1.0, float(i), 0.0]) for i in range(60)]
    assert _run(spark, rows, factor=1, shard_rows=50) == _by_hand(rows)


def test_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (20, []), (40, [0.0, 0.0]), (60, [float("nan"), 1.0]),
            (80, [float("inf"), 1.0]), (100, [None, 1.0]), (None, [1.0, 1.0]), (2, [3.0, -1.0]),
            (3, [-1.0, -2.0]), (120, [1.0, 2.0, 3.0]), (121, [1.0, 0.0, 0.0]), (140, [1e-30, 0.0])]
    got = _run(spark, rows, factor=1)
    assert got == _by_hand(rows)
    assert [r[2] for r in got if r[0] == 120] == [121]
    assert _run(spark, []) == []
    assert _run(spark, [(0, [1.0])]) == []


def test_repeated_rows_count_once(spark):
    rows = _clusters(4, 200)
    assert _run(spark, rows * 2, factor=1) == _by_hand(rows)


def test_ties_go_to_the_smaller_id(spark):
    rows = [(i, [1.0, 0.0]) for i in range(60)]
    got = _run(spark, rows, k=5)
    assert [r[2] for r in got if r[0] == 0] == [1, 2, 3, 4, 5]
    assert [r[2] for r in got if r[0] == 20] == [0, 1, 2, 3, 4]


def test_every_row_is_indexed(spark):
    rows = _clusters(6, 500)
    vectors = spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows], SCHEMA)
    # A sample of few rows fits the top levels; the answer stays exact.
    few = vantage.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0), factor=1,
                          shard_rows=30, sample_rows=60)
    got = sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in few.collect())
    assert got == _by_hand(rows)
