"""Plans keep the shape they were written for."""

from __future__ import annotations

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from footfall.operators import ads, scans, sessions, upsert
from footfall.params import TaskParams
from footfall.plans import queries as registry
from footfall.sources import fixtures
from tests.helpers import actions, lines, plan, users

SF_DIR = "/root/testdata/sf0.001"
BATCH = [name for name in registry.queries() if not name.startswith("stream_")]
STORED = ("course_day_scan", "course_day_report", "course_search_report")


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_python(spark, name):
    text = plan(registry.queries()[name](spark, SF_DIR))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "Arrow"):
        assert bad not in text


@pytest.mark.parametrize("name", [
    "top10_sessions", "area_top3_products", "ad_province_top3",
])
def test_groups_are_cut_before_the_shuffle(spark, name):
    text = plan(registry.queries()[name](spark, SF_DIR))
    final = re.search(r"WindowGroupLimit.* Final", text).start()
    exchange = text.index("Exchange hashpartitioning", final)
    assert exchange < re.search(r"WindowGroupLimit.* Partial", text).start()


def test_top_categories_need_no_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(registry.queries()["top10_categories"](spark, SF_DIR))


def test_counting_jobs_carry_no_lists(spark):
    for name in ("session_ratio", "top10_categories", "filtered_actions", "session_hour_count"):
        assert "collect_set" not in plan(registry.queries()[name](spark, SF_DIR)).split("Window")[0]


def test_scans_are_pruned_and_filtered(spark, tmp_path):
    path = str(tmp_path / "actions")
    fixtures.visit_actions(fixtures.events(spark, SF_DIR)).write.partitionBy("date").parquet(path)
    actions = spark.read.parquet(path).withColumn("date", F.col("date").cast("string"))
    p = TaskParams("2024-01-06", "2024-01-08")
    text = plan(scans.click_scan(actions, p))
    assert "PushedFilters: [IsNotNull(click_product_id), Not(EqualTo(click_product_id,-1))]" in text
    assert "ReadSchema: struct<click_product_id:bigint,city_id:bigint>" in text
    # A job without keyword and category filters reads three columns of the action table.
    text = plan(sessions.aggregate_sessions(scans.action_scan(actions, p), p, lists=False))
    assert "ReadSchema: struct<user_id:bigint,session_id:string,action_time:string>" in text


@pytest.fixture
def no_broadcast(spark):
    """Joins by shuffle, as with sides too large to send to every task."""
    settings = {
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_long_sessions_are_split(spark, no_broadcast):
    data = [{"session": "long", "page": i, "keyword": f"w{i * 7919 % 5000}"} for i in range(4000)]
    data += [{"session": None, "page": i} for i in range(500)]
    data += [{"session": f"s{i % 300}", "user": i % 300, "page": i} for i in range(2000)]
    df = actions(spark, *data).repartition(8)
    people = F.broadcast(users(spark, *[(i, 30, "p", "c", "male") for i in range(300)]))
    kept = sessions.keep_session_actions(df, sessions.matching_sessions(df, people, TaskParams()))
    assert len(kept.collect()) == 6500
    assert re.search(r"hashpartitioning\([^)]*_own_part", plan(kept))


def test_very_active_users_are_split(spark, no_broadcast):
    """One user holds half of all rows; the join deals the rows of each user into parts."""
    data = [f"{1704067200000 + i * 7919} 1 1 {i % 2 * (i % 200)} 1" for i in range(8000)]
    df = ads.parse_ad_log(lines(spark, *data)).repartition(8)
    for found in (ads.drop_over_limit(df, 30), ads.replay_blacklist(df, 30)):
        assert re.search(r"hashpartitioning\([^)]*_own_part", plan(found))
    clicks = Counter(i % 2 * (i % 200) for i in range(8000))
    want = sum(n for n in clicks.values() if n <= 30)
    assert ads.drop_over_limit(df, 30).count() == want


@pytest.mark.parametrize("name", STORED)
def test_reports_read_one_day(spark, name):
    text = plan(registry.queries()[name](spark, SF_DIR))
    assert re.search(r"PartitionFilters: \[isnotnull\(day#\d+\), \(day#\d+ = 20240105\)\]", text)


def test_top_sessions_read_the_actions_as_often_as_top_categories(spark):
    scans_of = {
        name: plan(registry.queries()[name](spark, SF_DIR)).count("events.parquet")
        for name in ("top10_categories", "top10_sessions")
    }
    assert scans_of["top10_sessions"] == 2 * scans_of["top10_categories"]


def test_extraction_has_no_global_window(spark):
    for name in ("extract_quota", "session_random_extract"):
        text = plan(registry.queries()[name](spark, SF_DIR))
        assert "Exchange SinglePartition" not in text.split("Subquery")[0]
        assert "rank" not in text or "windowspecdefinition(date" in text
    assert "specifiedwindowframe" in plan(registry.queries()["extract_quota"](spark, SF_DIR))


def test_groups_are_replaced_in_one_pass(spark):
    old = spark.createDataFrame([("g", 1, 5, 0), ("h", 1, 6, 0), ("g", 2, 7, 1)],
                                "grp STRING, k INT, v INT, version BIGINT")
    found = upsert.merge_versions(old, "replace_groups", ["grp", "k"], ["v"], ["grp"])
    assert len(re.findall(r"Exchange hash", plan(found))) == 1
    assert "Join" not in plan(found)
    assert sorted(map(tuple, found.collect())) == [("g", 2, 7), ("h", 1, 6)]
