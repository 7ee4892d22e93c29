from __future__ import annotations

import pytest

from footfall.functions import parsing
from footfall.operators import scans, sessions
from footfall.params import TaskParams
from tests.helpers import actions, rows, users


def test_scan_includes_both_dates(spark):
    df = actions(spark, *[{"date": f"2024-01-0{d}"} for d in range(1, 6)])
    p = TaskParams(start_date="2024-01-02", end_date="2024-01-04")
    assert [r[0] for r in rows(scans.action_scan(df, p), "date")] == [
        "2024-01-02", "2024-01-03", "2024-01-04"
    ]
    assert scans.action_scan(df, TaskParams()).count() == 5


def test_click_scan_leaves_out_other_actions(spark):
    df = actions(spark, {"product": 5, "city": 2}, {"product": -1}, {"product": 0, "city": 3})
    assert rows(scans.click_scan(df, TaskParams())) == [(2, 5), (3, 0)]


def test_aggregate(spark):
    df = actions(
        spark,
        {"time": "2024-01-01 9:59:58", "keyword": "apple iphone"},
        {"time": "2024-01-01 10:00:03", "keyword": "apple"},
        {"time": "2024-01-01 10:00:01", "click": 11},
        {"time": "2024-01-01 10:00:01", "click": 1},
        {"time": "2024-01-01 10:00:01", "click": 11},
        {"time": "2024-01-01 10:00:01", "click": 44},
        {"time": "2024-01-01 10:00:01", "click": 50},
        {"time": "2024-01-01 10:00:01", "keyword": ""},
        {"session": "single", "user": 2, "time": "2024-01-02 0:00:00"},
    )
    got = rows(
        sessions.render_sessions(sessions.aggregate_sessions(df)),
        "session_id", "user_id", "start_time", "end_time", "visit_length", "step_length",
        "search_keywords", "click_category_ids",
    )
    assert got == [
        ("s", 1, "2024-01-01 09:59:58", "2024-01-01 10:00:03", 5, 8, "apple,apple iphone",
         "1,11,44,50"),
        ("single", 2, "2024-01-02 00:00:00", "2024-01-02 00:00:00", 0, 1, None, None),
    ]


def test_sessions_without_user_vanish(spark):
    df = actions(spark, {"session": "a", "user": 1}, {"session": "b", "user": 9})
    full = sessions.enrich(sessions.aggregate_sessions(df), users(spark, (1, 30, "p", "c", "male")))
    assert rows(full, "session_id", "age", "sex") == [("a", 30, "male")]


@pytest.mark.parametrize("p, want", [
    (TaskParams(), "abcd"),
    (TaskParams(start_age=20), "abcd"),
    (TaskParams(end_age=20), "abcd"),
    (TaskParams(start_age=20, end_age=30), "ab"),
    (TaskParams(professionals=("p1", "p2")), "ab"),
    (TaskParams(cities=("c2",)), "b"),
    (TaskParams(sex="female"), "b"),
    (TaskParams(keywords=("ipad", "spark")), "ab"),
    (TaskParams(category_ids=(7, 8)), "cd"),
    (TaskParams(keywords=("spark",), category_ids=(7,)), ""),
    (TaskParams(keywords=("spark",), sex="male"), "a"),
])
def test_filter(spark, p, want):
    df = actions(
        spark,
        {"session": "a", "user": 1, "keyword": "spark"},
        {"session": "a", "user": 1, "keyword": "other"},
        {"session": "b", "user": 2, "keyword": "ipad"},
        {"session": "c", "user": 3, "click": 7},
        {"session": "d", "user": 4, "click": 8},
    )
    people = users(
        spark, (1, 20, "p1", "c1", "male"), (2, 30, "p2", "c2", "female"),
        (3, 31, "p3", "c3", "male"), (4, None, None, None, None),
    )
    for lists in (False, True):
        got = sessions.matching_sessions(df, people, p, lists)
        assert "".join(r[0] for r in rows(got, "session_id")) == want


def _sessions(spark, visits=(), steps=()):
    data = [(f"v{i}", v, 1000) for i, v in enumerate(visits)]
    data += [(f"s{i}", 0, s) for i, s in enumerate(steps)]
    return spark.createDataFrame(data, "session_id STRING, visit_length BIGINT, step_length BIGINT")


def test_bands(spark):
    visits = (0, 1, 3, 4, 9, 10, 30, 31, 60, 61, 180, 181, 600, 601, 1800, 1801)
    got = dict(sessions.visit_length_histogram(_sessions(spark, visits=visits)).collect())
    assert got == {
        "1s_3s": 2, "4s_6s": 1, "7s_9s": 1, "10s_30s": 2, "30s_60s": 2, "1m_3m": 2,
        "3m_10m": 2, "10m_30m": 2, "30m": 1,
    }
    got = dict(sessions.step_length_histogram(
        _sessions(spark, steps=(1, 3, 4, 30, 31, 60, 61))).collect())
    assert got == {"1_3": 2, "4_6": 1, "7_9": 0, "10_30": 1, "30_60": 2, "60": 1}


def test_ratios_round_half_up(spark):
    row = sessions.band_ratios(_sessions(spark, visits=[1] * 29 + [0] * 171)).first()
    assert row["session_count"] == 200
    assert row["visit_length_1s_3s_ratio"] == 0.15
    assert row["step_length_60_ratio"] == 1.0
    # Zero-second visits are in no band.
    assert sum(v for k, v in row.asDict().items() if k.startswith("visit")) == 0.15


def test_ratios_without_sessions(spark):
    row = sessions.band_ratios(_sessions(spark)).first()
    assert row["session_count"] == 0
    assert set(row[1:]) == {0.0}


@pytest.mark.parametrize("text, want", [
    ("2024-01-05 09:00:00", "2024-01-05 09:00:00"), ("2024-1-5 9:0:0", "2024-01-05 09:00:00"),
    ("2024-01-05 9:00:00", "2024-01-05 09:00:00"), ("2024-01-05        ", None),
    ("2024-01-05 10:00:00 +05:00", None), ("2024-01-05T10:00:00", None),
    ("2024-01-05 10:00:00.5", None), ("", None), (None, None), ("2024-02-30 10:00:00", None),
])
def test_times(spark, text, want):
    df = spark.createDataFrame([(text,)], "t STRING")
    got = df.select(parsing.format_time(parsing.action_timestamp(df.t))).first()[0]
    assert got == want


def test_values_in_long_form(spark):
    df = actions(spark, {"session": "a", "keyword": "k"}, {"session": "a", "keyword": "k"},
                 {"session": None, "click": 3}, {"session": "a", "keyword": ""}, {"click": -1})
    assert rows(sessions.session_values(df)) == [
        (None, "category", "3", 1), ("a", "keyword", "k", 2)
    ]


def test_actions_without_id_are_one_session(spark):
    df = actions(spark, {"session": None, "page": 1}, {"session": "x"}, {"session": None})
    kept = sessions.keep_session_actions(df, sessions.aggregate_sessions(df))
    assert kept.count() == 3


def test_session_actions(spark):
    df = actions(spark, {"session": "a"}, {"session": "a"}, {"session": "b"})
    kept = sessions.keep_session_actions(df, sessions.aggregate_sessions(df).filter("step_length = 2"))
    assert [r[0] for r in rows(kept, "session_id")] == ["a", "a"]
