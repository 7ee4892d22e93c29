"""The batch jobs end to end: scan, operators, result tables."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from footfall.operators import area, extract, page_flow, rankings, scans, sessions, traffic
from footfall.params import TaskParams
from footfall.sinks.results import ResultSink, new_task_id
from footfall.sources.dims import cities, courses
from footfall.streaming.traffic_stream import TrafficTables


def category_result(top: DataFrame) -> DataFrame:
    return top.selectExpr(
        "category_id AS categoryid", "click_count AS clickCount", "order_count AS orderCount",
        "pay_count AS payCount",
    )


def session_result(top: DataFrame) -> DataFrame:
    return top.selectExpr(
        "category_id AS categoryid", "session_id AS sessionid", "click_count AS clickCount"
    )


def run_session_job(
    actions: DataFrame, users: DataFrame, p: TaskParams, sink: ResultSink,
    task_id: str | None = None, extract_total: int = 100,
) -> str:
    """Band shares, random extract, top categories and their top sessions.

    All four results need the matching sessions, a few columns per session; they are kept.
    """
    task_id = task_id or new_task_id()
    ranged = scans.action_scan(actions, p)
    matching = sessions.matching_sessions(ranged, users, p).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sink.append(sessions.band_ratios(matching), "session_stat_ratio", task_id)
        drawn = extract.draw_sessions(matching, extract_total, seed=task_id)
        sink.append(extract.extract_rows(drawn, ranged), "session_random_extract", task_id)
        events = rankings.session_category_events(ranged, matching)
        # k rows, used twice.
        top = rankings.top_categories(rankings.category_counts(events)).persist()
        sink.append(category_result(top), "session_stat_top10category", task_id)
        clicks = rankings.session_category_clicks(events, top)
        sink.append(
            session_result(rankings.top_sessions(clicks)), "session_stat_top10session", task_id
        )
        top.unpersist()
    finally:
        matching.unpersist()
    return task_id


def run_page_job(
    actions: DataFrame, p: TaskParams, sink: ResultSink,
    task_id: str | None = None, direction: str = "desc",
) -> str:
    """Conversion rates along the task's page flow."""
    task_id = task_id or new_task_id()
    following = page_flow.following_pages(scans.action_scan(actions, p), direction)
    rates = page_flow.page_convert_rates(following, p.target_page_flow)
    sink.append(page_flow.page_convert_string(rates), "page_convert_ratio", task_id)
    return task_id


def area_clicks(spark: SparkSession, actions: DataFrame, p: TaskParams) -> DataFrame:
    """Click counts per area and product, also offered to SQL as two temporary views."""
    clicks = scans.click_scan(actions, p)
    area.area_click_detail(clicks, cities(spark)).createOrReplaceTempView("temp_area_basic_info")
    result = area.area_product_clicks(clicks, cities(spark))
    result.createOrReplaceTempView("tmp_area_click_count")
    return result


def run_area_job(
    spark: SparkSession, actions: DataFrame, p: TaskParams, sink: ResultSink,
    task_id: str | None = None, k: int = 3,
) -> str:
    """The most clicked products of every area."""
    task_id = task_id or new_task_id()
    top = area.top_area_products(area_clicks(spark, actions, p), k)
    sink.append(top, "area_top3_product", task_id)
    return task_id


def run_report_job(tables: TrafficTables, day: str, sink: ResultSink, task_id: str | None = None) -> str:
    """A day's course reports from the stored counters; only that day's are read."""
    task_id = task_id or new_task_id()
    names = courses(tables.courses.spark)
    counters = tables.courses.read(partitions=[day])
    shares = traffic.course_shares(counters, names)
    sink.append(shares.select("course_id", "name", "click_count", "share"), "course_report", task_id)
    searches = tables.searches.read(partitions=[day])
    sink.append(traffic.course_search_report(searches, names, day), "course_search_report", task_id)
    return task_id
