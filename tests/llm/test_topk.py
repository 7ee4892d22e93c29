from __future__ import annotations

import math

import numpy as np
import pytest

from footfall.llm import queries, topk
from tests.compare import differences, duck
from tests.llm.conftest import SMALL

SCHEMA = "vec_id long, embedding array<float>, label int, score string"


def _vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x") for i, v in rows], SCHEMA)


def _by_hand(rows, k):
    whole = {i: [math.floor(1024 * float(np.float32(x))) for x in v] for i, v in rows
             if i is not None and v is not None
             and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q in whole:
        if q % 100 == 0:
            hits = sorted((-sum(a * b for a, b in zip(whole[q], whole[i], strict=True)), i)
                          for i in whole if i != q and len(whole[i]) == len(whole[q]))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(hits)]
    return sorted(out)


def _run(spark, rows, **more):
    vectors = _vectors(spark, rows)
    return sorted(map(tuple, topk.top_k(vectors, vectors.where("vec_id % 100 = 0"), **more).collect()))


def test_query_equals_sql(spark):
    query = queries.op8_topk(spark, SMALL)
    assert differences(query, duck(SMALL), queries.oracle_sql()["op8_topk"]) == []


@pytest.mark.parametrize("shard_rows", [20, 100, 10_000])
def test_against_brute_force(spark, shard_rows):
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 1, (5, 6))
    rows = [(i, (centres[i % 5] + rng.normal(0, 0.1, 6)).tolist()) for i in range(500)]
    assert _run(spark, rows, shard_rows=shard_rows) == _by_hand(rows, 10)


def test_ties_nulls_and_few_rows(spark):
    same = [0.5, -0.25]
    rows = [(i, same) for i in range(300)] + [
        (300, None), (400, [None, 1.0]), (500, [float("nan"), 1.0]), (600, [float("inf"), 0.0]),
        (None, same), (700, [1.0, 2.0, 3.0]), (701, [3.0, 2.0, 1.0]), (800, [])]
    got = _run(spark, rows, shard_rows=30)
    assert got == _by_hand(rows, 10)
    assert [r for r in got if r[0] == 700] == [(700, 1, 701, 10 * 1024 * 1024)]
    assert _run(spark, [(0, same)]) == []
    assert _run(spark, []) == []


def test_repeated_rows_count_once(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.5, 0.0])]
    assert _run(spark, rows * 2) == _by_hand(rows, 10)


def test_tree_prunes():
    rng = np.random.default_rng(4)
    points = (np.repeat(np.eye(8), 500, axis=0) * 900 + rng.normal(0, 20, (4000, 8))).astype(int)
    tree = topk.KDTree(np.arange(4000), points, 10)
    seen = []
    reach = topk.KDTree._reach
    tree._reach = lambda *a: seen.append(1) or reach(*a)
    got = tree.search(-1, points[0], 10, None)
    scores = points @ points[0]
    want = sorted(zip((-scores).tolist(), range(4000), strict=True))[:10]
    assert got == [(-s, i) for s, i in want]
    assert len(seen) < len(tree.nodes)
