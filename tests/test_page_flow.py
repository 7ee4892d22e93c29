from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from footfall.operators import page_flow
from tests.helpers import actions, rows


def _by_hand(data, direction):
    """(event id, page, next page) by sorting every session."""
    sessions = {}
    for row in data:
        sessions.setdefault(row["session"], []).append(row)
    result = []
    for members in sessions.values():
        members.sort(key=lambda r: (r["time"], r["id"]), reverse=direction == "desc")
        after = [r["page"] for r in members[1:]] + [None]
        result += [(r["id"], r["page"], n) for r, n in zip(members, after)]
    return sorted(result)


def _data(n=400):
    """One session holds most rows; times tie often."""
    rng = random.Random(5)
    return [
        {
            "session": rng.choice(["long", "long", None, f"s{rng.randrange(40)}"]),
            "time": f"2024-01-01 {rng.randrange(3)}:00:{rng.randrange(6):02d}",
            "page": rng.randrange(5), "id": i,
        }
        for i in range(n)
    ]


@pytest.mark.parametrize("direction", ["desc", "asc"])
def test_following_pages(spark, direction):
    """The long session runs over three hours, with rows of every hour in any order."""
    data = _data()
    got = page_flow.following_pages(actions(spark, *data), direction)
    assert sorted(
        (tuple(r) for r in got.select("event_id", "page_id", "next_page_id").collect())
    ) == _by_hand(data, direction)


def test_sessions_over_many_hours(spark):
    times = [f"2024-01-0{1 + h // 24} {h % 24:02d}:30:00" for h in range(60)]
    data = [{"session": "a", "time": t, "page": i} for i, t in enumerate(times)]
    data.append({"session": "a", "time": "2024-1-3 12:0", "page": 99})  # no time: the oldest
    got = page_flow.following_pages(actions(spark, *data), "desc")
    pages = {r["page_id"]: r["next_page_id"] for r in got.collect()}
    assert pages == {**{i: i - 1 for i in range(1, 60)}, 0: 99, 99: None}
    got = page_flow.following_pages(actions(spark, *data), "asc")
    pages = {r["page_id"]: r["next_page_id"] for r in got.collect()}
    assert pages == {99: 0, **{i: i + 1 for i in range(59)}, 59: None}


@pytest.mark.parametrize("direction", ["desc", "asc"])
def test_crowded_hour_is_cut(spark, direction):
    """Two thirds of all rows in one second of one session, others without a time or a session."""
    rng = random.Random(7)
    data = [
        {
            "session": "crowd" if i % 3 else rng.choice([None, "a", "b"]),
            "time": "2024-01-01 10:00:00" if i % 3 else rng.choice(["", "2024-01-01 10:00:00"]),
            "page": rng.randrange(5), "id": i,
        }
        for i in range(600)
    ]
    df = actions(spark, *data)
    got = page_flow.following_pages(df, direction, cuts=64, drawn=1)
    assert sorted(
        (tuple(r) for r in got.select("event_id", "page_id", "next_page_id").collect())
    ) == _by_hand([{**r, "time": r["time"] or "0"} for r in data], direction)
    # No range of the crowd holds more than a small part of its 400 rows.
    rows = df.select(
        "session_id", "page_id", "event_id", F.xxhash64("session_id").alias("session_hash"),
        F.xxhash64("event_id").alias("number"), F.lit(0).alias("hour_key"), F.lit(None).cast("timestamp").alias("ts"))
    parts = (page_flow._with_parts(rows, ["ts", "event_id"], 64, 1)
             .where("session_id = 'crowd'").groupBy("part").count().collect())
    assert len(parts) > 20 and max(r["count"] for r in parts) < 80


@pytest.mark.parametrize("direction", ["desc", "asc"])
def test_rows_without_event_id_or_with_null_ids(spark, direction):
    df = actions(spark, *[{"session": "a", "page": i % 7, "id": i} for i in range(70)])
    bare = page_flow.following_pages(df.drop("event_id"), direction, cuts=32, drawn=1)
    pages = sorted([i % 7 for i in range(70)], reverse=direction == "desc")
    assert sorted(
        ((r.page_id, r.next_page_id) for r in bare.collect()), key=str
    ) == sorted(zip(pages, [*pages[1:], None]), key=str)
    half = df.withColumn("event_id", F.when(F.col("event_id") == 0, None).otherwise(F.col("event_id")))
    got = page_flow.following_pages(half, direction, cuts=32, drawn=1)
    after = {r.event_id: r.next_page_id for r in got.collect()}
    step = 1 if direction == "asc" else -1
    assert after == {i or None: (i + step) % 7 if 0 <= i + step < 70 else None for i in range(70)}


def test_building_the_query_runs_no_job(spark):
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup())
    page_flow.following_pages(actions(spark, *_data()))
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup()) == before


def test_single_action_has_no_pair(spark):
    df = actions(spark, {"session": "a", "page": 1}, {"session": "b", "page": 2})
    assert page_flow.page_pairs(page_flow.following_pages(df)).count() == 0


def _flow(spark, direction="asc"):
    df = actions(
        spark,
        *[{"session": "a", "page": p, "time": f"2024-01-01 10:00:{i:02d}"}
          for i, p in enumerate([1, 2, 1, 2, 3])],
        {"session": "b", "page": 1}, {"session": "b", "page": 1},
    )
    return page_flow.following_pages(df, direction)


def test_rates(spark):
    rates = page_flow.page_convert_rates(_flow(spark), (1, 2, 3, 9, 4, 5))
    assert [tuple(r) for r in rates.orderBy("step").collect()] == [
        (1, "1_2", 2, 0.5), (2, "2_3", 1, 0.5), (3, "3_9", 0, 0.0), (4, "9_4", 0, None),
        (5, "4_5", 0, None),
    ]
    text = page_flow.page_convert_string(rates, 4).first()[0]
    assert text == "1_2=0.5000|2_3=0.5000|3_9=0.0000|9_4=|4_5="
    assert page_flow.page_convert_string(rates).first()[0].startswith("1_2=0.5|2_3=0.5|")


def test_newest_first(spark):
    counts = page_flow.page_pair_counts(_flow(spark, "desc"), (1, 2, 1))
    assert [tuple(r) for r in counts.collect()] == [(1, "1_2", 1), (2, "2_1", 2)]


def test_target_pairs():
    assert page_flow.target_pairs((1, 2, 4)) == [(1, 1, 2), (2, 2, 4)]


def test_bad_parameters(spark):
    with pytest.raises(ValueError):
        page_flow.target_pairs((1,))
    with pytest.raises(ValueError):
        page_flow.following_pages(actions(spark, {}), "sideways")
