from __future__ import annotations

from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest

from footfall.operators import ads
from tests.helpers import lines, rows


def at(text: str) -> int:
    return int(datetime.fromisoformat(text).replace(tzinfo=timezone.utc).timestamp() * 1000)


def click(time: str, user=1, ad=1, province="3") -> str:
    return f"{at(time)} {province} {province} {user} {ad}"


def parsed(spark, *values):
    return ads.parse_ad_log(lines(spark, *values))


def test_parse_drops_and_counts_bad_lines(spark):
    source = lines(
        spark, "1704067200123 4 5 6 7", "1704067200123 4 5 6", "x 4 5 6 7", "", "1 4 5 y 7",
        "1704067200123 4 5 6 7 more", "9223372036854775807 4 5 6 7", "253402300800000 4 5 6 7",
    )
    want = (1704067200123, "4", "5", 6, 7)
    assert rows(ads.parse_ad_log(source)) == [want, want]
    assert rows(ads.user_day_clicks(ads.parse_ad_log(source))) == [("20240101", 6, 7, 2)]
    assert ads.count_ad_lines(source).first() == (8, 6)


def test_limit_is_exclusive(spark):
    df = parsed(
        spark, *[click("2024-01-01 10:00:00", user=1)] * 100,
        *[click("2024-01-01 10:00:00", user=2)] * 101,
        *[click("2024-01-01 10:00:00", user=3, ad=1)] * 60,
        *[click("2024-01-01 10:00:00", user=3, ad=2)] * 60,
        *[click("2024-01-01 23:59:59", user=4)] * 60,
        *[click("2024-01-02 00:00:00", user=4)] * 60,
    )
    totals = ads.user_day_clicks(df)
    assert rows(ads.over_limit_users(totals)) == [(2,)]
    left = ads.drop_over_limit(df)
    assert rows(left.select("userid").distinct()) == [(1,), (3,), (4,)]
    assert left.count() == 340


def test_lookup_gives_zero_for_absent_keys(spark):
    requests = spark.createDataFrame(
        [("20240101", 1, 1), ("20240101", 1, 2)], "date STRING, userid BIGINT, adid BIGINT"
    )
    counts = ads.user_day_clicks(parsed(spark, *[click("2024-01-01 10:00:00")] * 2))
    assert rows(ads.lookup_counts(requests, counts, list(ads.USER_KEYS))) == [
        ("20240101", 1, 1, 2), ("20240101", 1, 2, 0)
    ]


def test_replay_blocks_from_the_next_hour(spark):
    df = parsed(
        spark, *[click("2024-01-01 10:10:00")] * 2, *[click("2024-01-01 11:10:00")] * 3,
        click("2024-01-01 12:10:00"), click("2024-01-02 12:10:00"),
        click("2024-01-01 12:10:00", user=2),
    )
    left = ads.replay_blacklist(df, limit=4)
    # The hour in which the limit is passed still counts whole.
    assert rows(ads.user_day_clicks(left), "userid", "click_count") == [(1, 5), (2, 1)]
    assert ads.replay_blacklist(df, limit=6).count() == 8


def test_provinces(spark):
    df = parsed(
        spark,
        *[click("2024-01-01 10:00:00", ad=a, province="1") for a in (1, 1, 1, 2, 2, 3, 4, 4)],
        click("2024-01-01 10:00:00", ad=9, province="2"), "1704067200000 1 8 1 1",
    )
    cities = ads.province_city_clicks(df)
    assert ("20240101", "1", "8", 1, 1) in rows(cities)
    top = ads.top_province_ads(ads.province_clicks(cities))
    assert rows(top) == [
        ("20240101", "1", 1, 4), ("20240101", "1", 2, 2), ("20240101", "1", 4, 2),
        ("20240101", "2", 9, 1),
    ]


def test_trend_covers_the_last_sixty_minutes(spark):
    df = parsed(
        spark, click("2024-01-01 10:00:59"), click("2024-01-01 10:01:00"),
        click("2024-01-01 10:01:59"), click("2024-01-01 11:00:30", ad=2),
    )
    assert rows(ads.hour_trend(df)) == [
        ("20240101", "10", "01", 1, 2), ("20240101", "11", "00", 2, 1)
    ]
    assert rows(ads.hour_trend(df, minutes=1)) == [("20240101", "11", "00", 2, 1)]


@pytest.mark.parametrize("seed", [1, 2])
def test_sliding_windows(spark, seed):
    import random
    rng = random.Random(seed)
    minutes = [rng.randrange(90) for _ in range(40)]
    df = parsed(spark, *[click(f"2024-01-01 {10 + m // 60}:{m % 60:02d}:17") for m in minutes])
    got = {r["window_start"]: r["click_count"] for r in ads.sliding_clicks(df).collect()}
    want = {}
    for start in range(-59, 90):
        n = sum(start <= m < start + 60 for m in minutes)
        if n:
            h, m = divmod(600 + start, 60)
            want[f"2024-01-01 {h:02d}:{m:02d}"] = n
    assert got == want


def test_sliding_sums_over_days_and_gaps(spark):
    """Each window by hand; a count enters with one window and leaves with another."""
    times = ["2024-01-01 23:30:30", "2024-01-01 23:59:59", "2024-01-02 00:00:00",
             "2024-01-02 00:20:10", "2024-01-04 05:00:00", "1969-12-31 23:10:00"]
    df = parsed(spark, *[click(t, ad=1) for t in times], click(times[2], ad=2))
    got = {(r["window_start"], r["adid"]): r["click_count"] for r in ads.sliding_clicks(df).collect()}
    want = Counter()
    for ad, at_ in [(1, t) for t in times] + [(2, times[2])]:
        minute = datetime.fromisoformat(at_).replace(second=0)
        for back in range(60):
            want[f"{minute - timedelta(minutes=back):%Y-%m-%d %H:%M}", ad] += 1
    assert got == want


def test_sliding_sums_shuffle_two_changes_for_each_count(spark):
    df = parsed(spark, *[click(f"2024-01-0{1 + m % 5} {m % 24:02d}:{m % 60:02d}:00", ad=m % 3)
                         for m in range(500)])
    counts = df.selectExpr("floor(ts_ms / 60000) AS m", "adid").distinct().count()
    changes = ads.slide_changes(df, 60, 1)
    assert counts < changes.count() <= 2 * counts
    assert changes.agg({"change": "sum"}).first()[0] == 0


def test_trend_reads_the_lines_once(spark):
    df = ads.parse_ad_log(lines(spark, click("2024-01-01 10:00:00"), click("2024-01-01 11:30:00")))
    trend = ads.hour_trend(df)
    assert [r["hour"] for r in trend.collect()] == ["11"]
    text = trend._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in text or text.count("Scan ExistingRDD") <= 2
