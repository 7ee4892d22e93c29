from __future__ import annotations

import pytest

from footfall.operators import rankings
from footfall.operators.ranking import top_per_group
from tests.helpers import actions, rows


@pytest.fixture(scope="module")
def df(spark):
    return actions(
        spark,
        *[{"session": "a", "click": 1}] * 3, *[{"session": "b", "click": 2}] * 3,
        {"session": "a", "order": "2,3,3"}, {"session": "b", "order": "1"},
        {"session": "c", "pay": "4"}, {"session": "c", "pay": "1,x,5,"}, {"session": "c"},
    )


def test_counts(df):
    counts = rankings.category_counts(rankings.category_events(df))
    assert rows(counts, "category_id", "click_count", "order_count", "pay_count") == [
        (1, 3, 1, 1), (2, 3, 1, 0), (3, 0, 2, 0), (4, 0, 0, 1), (5, 0, 0, 1)
    ]


def test_single_kind_counts(df):
    events = rankings.category_events(df)
    assert rows(rankings.kind_counts(events, "click")) == [(1, 3), (2, 3)]
    assert rows(rankings.kind_counts(events, "order")) == [(1, 1), (2, 1), (3, 2)]
    assert rows(rankings.kind_counts(events, "pay")) == [(1, 1), (4, 1), (5, 1)]
    assert rows(rankings.category_candidates(events)) == [(1,), (2,), (3,), (4,), (5,)]


def test_order_of_categories(df):
    counts = rankings.category_counts(rankings.category_events(df))
    full = [r["category_id"] for r in rankings.top_categories(counts, 10).collect()]
    # Equal clicks are ranked by orders, then payments, then id.
    assert full == [1, 2, 3, 4, 5]
    for k in range(5):
        assert [r["category_id"] for r in rankings.top_categories(counts, k).collect()] == full[:k]


def test_only_given_sessions_count(spark, df):
    kept = spark.createDataFrame([("b",)], "session_id STRING")
    counts = rankings.category_counts(rankings.session_category_events(df, kept))
    assert rows(counts, "category_id", "click_count", "order_count") == [(1, 0, 1), (2, 3, 0)]


def test_session_clicks(spark, df):
    kept = spark.createDataFrame([("a",), ("b",), ("c",)], "session_id STRING")
    top = spark.createDataFrame([(1,), (4,)], "category_id BIGINT")
    events = rankings.session_category_events(df, kept)
    assert rows(rankings.session_category_clicks(events, top)) == [("a", 1, 3)]


def test_sessions_without_id_count(spark):
    df = actions(spark, {"session": None, "click": 1}, {"session": "x", "click": 1},
                 {"session": None, "click": 2})
    kept = spark.createDataFrame([(None,), ("x",)], "session_id STRING")
    events = rankings.session_category_events(df, kept)
    assert rows(rankings.kind_counts(events, "click")) == [(1, 2), (2, 1)]
    top = rankings.top_categories(rankings.category_counts(events))
    assert rankings.session_category_clicks(events, top).count() == 3


def test_malformed_ids_are_counted(df):
    assert rankings.count_category_ids(df).first() == (9, 2)


def test_top_sessions(spark):
    clicks = spark.createDataFrame(
        [(f"s{i:02d}", 7, 100 - i // 2) for i in range(30)] + [("z", 8, 1)],
        "session_id STRING, category_id BIGINT, click_count BIGINT",
    )
    got = rows(rankings.top_sessions(clicks, 3), "category_id", "session_id", "click_count")
    assert got == [(7, "s00", 100), (7, "s01", 100), (7, "s02", 99), (8, "z", 1)]


def test_top_per_group_is_a_prefix(spark):
    df = spark.range(200).selectExpr("id % 3 AS g", "id * 37 % 101 AS v", "id")
    order = [df.v.desc(), df.id.asc()]
    full = rows(top_per_group(df, ["g"], order, 1000))
    assert len(full) == 200
    by_hand = {}
    for g, v, i in sorted(full, key=lambda r: (r[0], -r[1], r[2])):
        by_hand.setdefault(g, []).append((g, v, i))
    want = sorted(sum((v[:4] for v in by_hand.values()), []), key=lambda r: tuple(map(str, r)))
    assert rows(top_per_group(df, ["g"], order, 4)) == want
