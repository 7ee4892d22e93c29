from __future__ import annotations

from collections import Counter
from math import floor

from pyspark.sql import functions as F

from footfall.operators import extract, sessions
from tests.helpers import actions, rows

# Day and hour -> sessions; the hour of 200 holds most of them.
HOURS = {("2024-01-01", 9): 200, ("2024-01-01", 10): 50, ("2024-01-02", 0): 3, ("2024-01-03", 5): 1}


def _sessions(spark):
    data = [
        (f"{date}-{hour}-{i}", f"{date} {hour:02d}:{i % 60:02d}:00")
        for (date, hour), n in HOURS.items() for i in range(n)
    ]
    df = spark.createDataFrame(data, "session_id STRING, at STRING")
    return df.select("session_id", F.to_timestamp("at").alias("start_time"))


def _quotas(total):
    per_day = total // 3
    days = Counter()
    for (date, _), n in HOURS.items():
        days[date] += n
    return {
        (date, hour): min(n, floor(n / days[date] * per_day)) for (date, hour), n in HOURS.items()
    }


def test_quotas(spark):
    for total in (2, 100, 700):
        got = extract.extract_quotas(_sessions(spark), total)
        assert {(r["date"], r["hour"]): r["quota"] for r in got.collect()} == _quotas(total)
    assert _quotas(100) == {
        ("2024-01-01", 9): 26, ("2024-01-01", 10): 6, ("2024-01-02", 0): 3, ("2024-01-03", 5): 1
    }


def test_draw_meets_quotas_without_duplicates(spark):
    source = _sessions(spark).cache()
    for total in (100, 700):
        drawn = [r["session_id"] for r in extract.draw_sessions(source, total, "x").collect()]
        assert len(drawn) == len(set(drawn)) <= total
        per_hour = Counter((s[:10], int(s.split("-")[3])) for s in drawn)
        assert per_hour == Counter(_quotas(total))


def test_seed_decides_the_draw(spark):
    source = _sessions(spark).cache()
    first, again, other = (
        {r[0] for r in extract.draw_sessions(source, 100, seed).collect()} for seed in "aab"
    )
    assert first == again != other


def test_sessions_without_id_or_time(spark):
    df = actions(spark, {"session": None, "keyword": "a"}, {"session": "x", "time": "no time"})
    both = sessions.aggregate_sessions(df)
    assert both.count() == 2
    assert rows(extract.hour_counts(both)) == [("2024-01-01", 10, 1)]
    drawn = extract.draw_sessions(both, 10)
    assert rows(extract.extract_rows(drawn, df)) == [(None, "2024-01-01 10:00:00", "a", None)]


def test_no_sessions_give_no_rows(spark):
    none = _sessions(spark).filter("false")
    assert extract.draw_sessions(none).count() == 0


def test_rows_carry_lists_of_drawn_sessions(spark):
    df = actions(
        spark,
        {"session": "a", "keyword": "b"}, {"session": "a", "keyword": "a"},
        {"session": "a", "click": 10}, {"session": "a", "click": 9}, {"session": "b", "click": 1},
        {"session": "c"},
    )
    drawn = spark.createDataFrame([("a",), ("c",)], "session_id STRING").withColumn(
        "start_time", F.to_timestamp(F.lit("2024-01-01 10:00:00"))
    )
    assert rows(extract.extract_rows(drawn, df)) == [
        ("a", "2024-01-01 10:00:00", "a,b", "9,10"), ("c", "2024-01-01 10:00:00", None, None)
    ]
