"""Streams leave what a plain replay of their micro-batches gives."""

from __future__ import annotations

import os
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from footfall.operators import ads, traffic
from footfall.sinks.keyed_table import KeyedTable
from footfall.sources import fixtures, streams
from footfall.streaming import ad_stream, traffic_stream
from tests.helpers import lines, rows
from tests.test_ads import click

SF_DIR = "/root/testdata/sf0.001"
LIMIT = 12


@pytest.fixture(scope="module")
def events(spark):
    return fixtures.events(spark, SF_DIR).cache()


def split_files(df, folder, parts):
    """Write a frame as ``parts`` files that a file stream reads in order."""
    os.makedirs(folder)
    data = df.orderBy("event_id").toPandas()
    size = -(-len(data) // parts)
    for i in range(parts):
        name = f"{folder}/events-{i}.parquet"
        data.iloc[i * size:(i + 1) * size].astype({"ts": "datetime64[us]"}).to_parquet(name)
        os.utime(name, (1_700_000_000 + i, 1_700_000_000 + i))
    return [data.iloc[i * size:(i + 1) * size] for i in range(parts)]


def replay(batches):
    """The ad stream by hand: micro-batches of (date, hour, minute, province, city, user, ad)."""
    users, cities, trend, blocked, top = Counter(), Counter(), Counter(), set(), {}
    for batch in batches:
        kept = [r for r in batch if r[5] not in blocked]
        for date, hour, minute, province, city, user, ad in kept:
            users[date, user, ad] += 1
            cities[date, province, city, ad] += 1
            trend[date, hour, minute, ad] += 1
        blocked |= {user for (_, user, _), n in users.items() if n > LIMIT}
        for group in {(r[0], r[3]) for r in kept}:
            totals = Counter()
            for (date, province, _, ad), n in cities.items():
                if (date, province) == group:
                    totals[ad] += n
            top[group] = sorted(totals.items(), key=lambda x: (-x[1], x[0]))[:3]
    ranked = {(*group, ad): n for group, best in top.items() for ad, n in best}
    return users, cities, trend, blocked, ranked


def as_counts(table):
    return {tuple(r)[:-1]: r["click_count"] for r in table.read().collect()}


def check(tables, expected):
    users, cities, trend, blocked, ranked = expected
    assert as_counts(tables.user_clicks) == users
    assert as_counts(tables.city_clicks) == cities
    assert as_counts(tables.trend) == trend
    assert {r[0] for r in tables.blacklist.read().collect()} == blocked
    assert as_counts(tables.province_top) == ranked


def by_hand(df):
    minute = ads.count_minutes(ads.parse_ad_log(fixtures.ad_lines(df)), "province", "city", "userid", "adid")
    cells = minute.collect()
    return [tuple(c)[:3] + tuple(c)[3:7] for c in cells for _ in range(c["click_count"])]


def totals(spark, tables, folder, **options):
    """Work off what the clicks query has handed on."""
    for query in (
        ad_stream.start_places(spark, tables, f"{folder}/places", None, **options),
        ad_stream.start_minutes(spark, tables, f"{folder}/minutes", None),
    ):
        query.awaitTermination()


@pytest.mark.parametrize("parts", [1, 2, 5])
def test_ad_stream(spark, events, tmp_path, parts):
    batches = split_files(events, f"{tmp_path}/in", parts)
    tables = ad_stream.AdTables.at(spark, f"{tmp_path}/tables", compact_every=2)
    source = fixtures.ad_lines(fixtures.event_stream(spark, f"{tmp_path}/in", files_per_trigger=1))
    ad_stream.run_ad_stream(source, tables, f"{tmp_path}/checkpoint", limit=LIMIT)
    ids = [set(b["event_id"]) for b in batches]
    expected = replay([
        by_hand(events.filter(F.col("event_id").between(min(i), max(i)))) for i in ids
    ])
    assert (parts == 1) or expected[3]
    check(tables, expected)


def test_batches_can_run_again(spark, events, tmp_path):
    tables = ad_stream.AdTables.at(spark, f"{tmp_path}/t", compact_every=2)
    halves = [events.filter("event_id < 500"), events.filter("event_id >= 500")]
    for batch_id in (0, 0, 1, 1):
        ad_stream.process_clicks(
            fixtures.ad_lines(halves[batch_id]), batch_id, tables, limit=LIMIT
        )
    totals(spark, tables, tmp_path)
    check(tables, replay([by_hand(h) for h in halves]))


def test_batch_that_runs_again_hands_nothing_on_twice(spark, tmp_path):
    tables = ad_stream.AdTables.at(spark, f"{tmp_path}/t")
    batch = lines(spark, *[click("2024-01-01 10:00:00")] * 3)
    ad_stream.process_clicks(batch, 0, tables)
    totals(spark, tables, tmp_path)
    ad_stream.process_clicks(batch, 0, tables)
    totals(spark, tables, tmp_path)
    assert [r["click_count"] for r in tables.city_clicks.read().collect()] == [3]


def test_totals_do_not_read_earlier_totals(spark, tmp_path, monkeypatch):
    tables = ad_stream.AdTables.at(spark, f"{tmp_path}/t")
    read = []
    plain = KeyedTable._load
    monkeypatch.setattr(KeyedTable, "_load", lambda self, folders: (
        read.extend(f for f in folders), plain(self, folders))[1])
    for batch_id in range(3):
        batch = [click(f"2024-01-0{day} 10:00:00", ad=day) for day in (1, 2 + batch_id)]
        ad_stream.process_clicks(lines(spark, *batch), batch_id, tables)
        read.clear()
        totals(spark, tables, tmp_path)
        assert {f.split("/")[-3] for f in read} <= {"ad_province_top3"}
        changed = spark.read.parquet(f"{tables.city_clicks.path}/delta/version={batch_id}")
        assert {r["date"] for r in changed.collect()} == {"20240101", f"2024010{2 + batch_id}"}
    assert rows(tables.city_clicks.read(), "date", "click_count") == [
        ("20240101", 3), ("20240102", 1), ("20240103", 1), ("20240104", 1)]


def test_known_users_are_not_listed_again(spark, tmp_path):
    tables = ad_stream.AdTables.at(spark, f"{tmp_path}/t")
    for batch_id in range(2):
        batch = [click("2024-01-01 10:00:00", user=user) for user in (1, 2 + batch_id)] * 6
        ad_stream.process_clicks(lines(spark, *batch), batch_id, tables, limit=5)
    listed = [rows(spark.read.parquet(f"{tables.blacklist.path}/delta/version={n}"))
              for n in range(2)]
    assert listed == [[(1,), (2,)], [(3,)]]


def test_lookups_open_the_touched_buckets_alone(spark, tmp_path, monkeypatch):
    tables = ad_stream.AdTables.at(spark, f"{tmp_path}/t", compact_every=1)
    crowd = [click("2024-01-01 10:00:00", user=user) for user in range(200)]
    ad_stream.process_clicks(lines(spark, *crowd), 0, tables)
    assert len(list((tmp_path / "t" / "ad_user_click_count" / "base" / "version=0").glob(
        "bucket=*"))) == ad_stream.USER_BUCKETS
    loaded = []
    plain = KeyedTable._load
    monkeypatch.setattr(KeyedTable, "_load", lambda self, folders: (
        loaded.extend(f for f in folders if "user_click" in f), plain(self, folders))[1])
    asked = spark.createDataFrame([("20240101", 7, 1), ("20240101", 999, 1)],
                                  "date STRING, userid BIGINT, adid BIGINT")
    assert rows(tables.user_clicks.lookup(asked)) == [("20240101", 7, 1, 1)]
    assert 1 <= len(loaded) <= 2


def test_hourly_batches_equal_the_batch_replay(spark, tmp_path):
    tables = ad_stream.AdTables.at(spark, str(tmp_path))
    hours = [
        [click(f"2024-01-01 {h:02d}:{m:02d}:00", user=m % 4, ad=m % 2) for m in range(0, 50, 1 + h % 3)]
        for h in range(9, 13)
    ]
    for batch_id, hour in enumerate(hours):
        ad_stream.process_clicks(lines(spark, *hour), batch_id, tables, limit=20)
    everything = ads.parse_ad_log(lines(spark, *sum(hours, [])))
    survivors = ads.replay_blacklist(everything, limit=20)
    assert survivors.count() < everything.count()
    assert rows(tables.user_clicks.read()) == rows(ads.user_day_clicks(survivors))


def test_top_lists_follow_the_running_totals(spark, tmp_path):
    tables = ad_stream.AdTables.at(spark, f"{tmp_path}/t", compact_every=2)
    batches = [[1] * 5 + [2] * 2, [2] * 2 + [3], [2] * 2 + [3] * 5]
    for batch_id, ads_ in enumerate(batches):
        batch = [click("2024-01-01 10:00:00", ad=ad) for ad in ads_]
        ad_stream.process_clicks(lines(spark, *batch), batch_id, tables)
        totals(spark, tables, tmp_path, top_k=2)
        clicks = Counter(sum(batches[:batch_id + 1], []))
        best = sorted(clicks.items(), key=lambda x: (-x[1], x[0]))[:2]
        assert rows(tables.province_top.read(), "adid", "click_count") == sorted(best)


def test_empty_batch(spark, tmp_path):
    tables = ad_stream.AdTables.at(spark, f"{tmp_path}/t", compact_every=1)
    ad_stream.process_clicks(lines(spark, "not a click"), 0, tables)
    totals(spark, tables, tmp_path)
    assert tables.user_clicks.read().count() == 0
    assert tables.city_clicks.read().count() == 0
    ad_stream.process_clicks(lines(spark, click("2024-01-01 10:00:00"), "", "x"), 1, tables)
    assert tables.user_clicks.read().count() == 1
    assert rows(tables.malformed.read()) == [("ad log", 3)]


def write_lines(folder, *files):
    os.makedirs(folder)
    for i, content in enumerate(files):
        path = f"{folder}/{i}.txt"
        with open(path, "w") as f:
            f.write("\n".join(content) + "\n")
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))


def test_late_rows_count(spark, tmp_path):
    write_lines(
        f"{tmp_path}/in",
        [click("2024-01-01 12:00:00")],
        [click("2024-01-01 14:00:00")],
        [click("2023-01-01 10:00:00"), click("2024-01-01 12:00:30")],
    )
    tables = ad_stream.AdTables.at(spark, f"{tmp_path}/t")
    source = streams.text_lines(spark, f"{tmp_path}/in", files_per_trigger=1)
    ad_stream.run_ad_stream(source, tables, f"{tmp_path}/cp")
    assert [(r[0][:4], r[1], r[4]) for r in rows(tables.trend.read())] == [
        ("2023", "10", 1), ("2024", "12", 2), ("2024", "14", 1)
    ]
    assert [r[1:3] for r in rows(ads.last_minutes(tables.trend.read(), 121))] == [
        ("12", "00"), ("14", "00")
    ]
    assert [r[1:3] for r in rows(ads.last_minutes(tables.trend.read()))] == [("14", "00")]


def test_user_totals_over_many_days(spark, tmp_path):
    tables = ad_stream.AdTables.at(spark, str(tmp_path))
    batch = [click(f"2024-01-0{day} 10:00:00", user=2) for day in range(1, 6)] * 3
    for batch_id in range(2):
        ad_stream.process_clicks(lines(spark, *batch), batch_id, tables, limit=5)
    assert [r[3] for r in rows(tables.user_clicks.read())] == [6] * 5
    assert rows(tables.blacklist.read()) == [(2,)]


def test_queries_run_side_by_side(spark, tmp_path):
    write_lines(f"{tmp_path}/in", [click("2024-01-01 12:00:00")] * 4)
    tables = ad_stream.AdTables.at(spark, f"{tmp_path}/t")
    stream = ad_stream.start_ad_stream(
        streams.text_lines(spark, f"{tmp_path}/in"), tables, f"{tmp_path}/cp", "200 milliseconds")
    try:
        for _ in range(120):
            done = [rows(t.read(), "click_count") for t in (tables.city_clicks, tables.trend)]
            if done == [[(4,)], [(4,)]]:
                break
            time.sleep(0.5)
    finally:
        stream.stop()
    assert done == [[(4,)], [(4,)]]


@pytest.mark.parametrize("parts", [1, 2, 5])
def test_traffic_stream(spark, events, tmp_path, parts):
    split_files(events, f"{tmp_path}/in", parts)
    tables = traffic_stream.TrafficTables.at(spark, f"{tmp_path}/tables", compact_every=2)
    source = fixtures.access_lines(
        fixtures.event_stream(spark, f"{tmp_path}/in", files_per_trigger=1)
    )
    traffic_stream.start_traffic_stream(
        source, tables, f"{tmp_path}/checkpoint", interval=None
    ).awaitTermination()
    clicks = traffic.parse_access_log(fixtures.access_lines(events))
    assert rows(tables.courses.read()) == rows(traffic.course_daily(clicks))
    assert rows(tables.searches.read()) == rows(traffic.course_search_daily(clicks))


def test_stream_goes_on_from_its_checkpoint(spark, tmp_path):
    tables = traffic_stream.TrafficTables.at(spark, f"{tmp_path}/tables")
    line = '10.0.0.1\t2024-01-05 10:11:12\t"GET /class/112.html HTTP/1.1"\t-\t200'
    write_lines(f"{tmp_path}/in", [line])
    for n in (1, 2):
        source = streams.text_lines(spark, f"{tmp_path}/in")
        traffic_stream.start_traffic_stream(
            source, tables, f"{tmp_path}/cp", interval=None
        ).awaitTermination()
        assert rows(tables.courses.read()) == [("20240105", 112, n)]
        with open(f"{tmp_path}/in/more-{n}.txt", "w") as f:
            f.write(line + "\n")


def test_malformed_access_lines_are_counted(spark, tmp_path):
    good = '10.0.0.1\t2024-01-05 10:11:12\t"GET /class/112.html HTTP/1.1"\t-\t200'
    other = '10.0.0.1\t2024-01-05 10:11:12\t"GET /course/list HTTP/1.1"\t-\t200'
    write_lines(f"{tmp_path}/in", *[[good, other, "bad", "a\tb"]] * 2)
    tables = traffic_stream.TrafficTables.at(spark, f"{tmp_path}/t")
    source = streams.text_lines(spark, f"{tmp_path}/in", files_per_trigger=1)
    traffic_stream.start_traffic_stream(
        source, tables, f"{tmp_path}/cp", interval=None).awaitTermination()
    assert rows(tables.malformed.read()) == [("access log", 4)]
    assert rows(tables.courses.read()) == [("20240105", 112, 2)]


def test_traffic_batches_read_no_earlier_counters(spark, tmp_path, monkeypatch):
    line = '10.0.0.1\t2024-01-0{}\t"GET /class/112.html HTTP/1.1"\thttps://x.com/s\t200'
    write_lines(f"{tmp_path}/in", *[[line.format(f"{day} 10:00:00")] for day in (5, 6, 5)])
    tables = traffic_stream.TrafficTables.at(spark, f"{tmp_path}/t")
    loads = []
    monkeypatch.setattr(KeyedTable, "_load", lambda self, folders: loads.append(folders))
    traffic_stream.start_traffic_stream(
        streams.text_lines(spark, f"{tmp_path}/in", files_per_trigger=1), tables,
        f"{tmp_path}/cp", interval=None).awaitTermination()
    assert loads == []
    monkeypatch.undo()
    assert rows(spark.read.parquet(f"{tables.courses.path}/delta/version=2")) == [
        ("20240105", 112, 2)]
    assert rows(tables.courses.read()) == [("20240105", 112, 2), ("20240106", 112, 1)]


def test_state_is_kept_in_rocksdb(spark, tmp_path):
    write_lines(f"{tmp_path}/in", ["x"])
    tables = traffic_stream.TrafficTables.at(spark, f"{tmp_path}/t")
    query = traffic_stream.start_traffic_stream(
        streams.text_lines(spark, f"{tmp_path}/in"), tables, f"{tmp_path}/cp", interval=None)
    query.awaitTermination()
    state = query.lastProgress["stateOperators"][0]
    assert "rocksdbPutCount" in state["customMetrics"]
    assert list((tmp_path / "cp" / "state" / "0" / "0").glob("*.changelog"))
