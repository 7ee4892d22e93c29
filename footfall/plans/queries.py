"""Every checked query by name: ``(spark, folder of the supplied tables) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions import sql_functions
from footfall.operators import (
    ads, area, extract, page_flow, rankings, scans, sessions, traffic, upsert,
)
from footfall.params import TaskParams
from footfall.plans.jobs import category_result, session_result
from footfall.session import configure, run_dir
from footfall.sinks.results import tag_task
from footfall.sources import dims, fixtures
from footfall.streaming import ad_stream, traffic_stream

Query = Callable[[SparkSession, str], DataFrame]

TASK_ID = "task-1"
MONTH = TaskParams(start_date="2024-01-01", end_date="2024-01-31")
HALF_MONTH = TaskParams(start_date="2024-01-06", end_date="2024-01-20")
ADULTS = TaskParams(start_date="2024-01-01", end_date="2024-01-31", start_age=20, end_age=50)
SEARCHERS = TaskParams(
    start_date="2024-01-01", end_date="2024-01-31", start_age=20, end_age=50,
    keywords=("spark", "ipad"),
)
PICKED = TaskParams(
    start_date="2024-01-01", end_date="2024-01-31", start_age=10, end_age=55,
    professionals=tuple(f"professional{i}" for i in range(80)),
    cities=tuple(f"city{i}" for i in range(20)), sex="male",
    keywords=("spark", "ipad", "food"), category_ids=tuple(range(60)),
)
THREE_DAYS = TaskParams(start_date="2024-01-06", end_date="2024-01-08", start_age=20, end_age=50)
FLOW = MONTH.target_page_flow
EXTRACT_TOTAL = 900
REPORT_DAY = "20240105"

_QUERIES: dict[str, Query] = {}


def _query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    _QUERIES[fn.__name__] = run
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- inputs -------------------------------------------------------------------------------------

def _actions(spark: SparkSession, sf_dir: str, p: TaskParams = MONTH) -> DataFrame:
    return scans.action_scan(fixtures.visit_actions(fixtures.events(spark, sf_dir)), p)


def _matching(spark: SparkSession, sf_dir: str, p: TaskParams, lists: bool = False) -> DataFrame:
    actions = _actions(spark, sf_dir, p)
    return sessions.matching_sessions(actions, fixtures.users(spark, sf_dir), p, lists)


def _category_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rankings.session_category_events(
        _actions(spark, sf_dir, ADULTS), _matching(spark, sf_dir, ADULTS)
    )


def _clicks(spark: SparkSession, sf_dir: str, p: TaskParams = MONTH) -> DataFrame:
    return scans.click_scan(fixtures.visit_actions(fixtures.events(spark, sf_dir)), p)


def _ads(spark: SparkSession, sf_dir: str, since: str | None = None, before: str | None = None):
    part = fixtures.month(fixtures.events(spark, sf_dir), since, before)
    return ads.parse_ad_log(fixtures.ad_lines(part))


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic.parse_access_log(fixtures.access_lines(fixtures.events(spark, sf_dir)))


# --- scans --------------------------------------------------------------------------------------

@_query
def action_range_scan(spark, sf_dir):
    return _actions(spark, sf_dir, HALF_MONTH)


@_query
def area_click_scan(spark, sf_dir):
    return _clicks(spark, sf_dir, HALF_MONTH)


# --- sessions -----------------------------------------------------------------------------------

@_query
def session_aggregate(spark, sf_dir):
    return sessions.render_sessions(
        sessions.aggregate_sessions(_actions(spark, sf_dir), lists=False)
    )


@_query
def session_values(spark, sf_dir):
    return sessions.session_values(_actions(spark, sf_dir))


@_query
def session_full_info(spark, sf_dir):
    full = sessions.enrich(
        sessions.aggregate_sessions(_actions(spark, sf_dir), lists=False),
        fixtures.users(spark, sf_dir),
    )
    return sessions.render_sessions(full)


@_query
def session_filter(spark, sf_dir):
    return sessions.render_sessions(_matching(spark, sf_dir, SEARCHERS))


@_query
def session_filter_all(spark, sf_dir):
    return sessions.render_sessions(_matching(spark, sf_dir, PICKED))


@_query
def filtered_actions(spark, sf_dir):
    return sessions.keep_session_actions(
        _actions(spark, sf_dir, SEARCHERS), _matching(spark, sf_dir, SEARCHERS)
    )


@_query
def visit_length_histogram(spark, sf_dir):
    return sessions.visit_length_histogram(_matching(spark, sf_dir, ADULTS))


@_query
def step_length_histogram(spark, sf_dir):
    return sessions.step_length_histogram(_matching(spark, sf_dir, ADULTS))


@_query
def session_ratio(spark, sf_dir):
    return tag_task(sessions.band_ratios(_matching(spark, sf_dir, ADULTS)), TASK_ID)


# --- random extraction --------------------------------------------------------------------------

@_query
def session_hour_count(spark, sf_dir):
    return extract.hour_counts(_matching(spark, sf_dir, ADULTS))


@_query
def extract_quota(spark, sf_dir):
    return extract.extract_quotas(_matching(spark, sf_dir, ADULTS), EXTRACT_TOTAL)


@_query
def session_random_extract(spark, sf_dir):
    drawn = extract.draw_sessions(_matching(spark, sf_dir, ADULTS), EXTRACT_TOTAL, TASK_ID)
    return tag_task(extract.extract_rows(drawn, _actions(spark, sf_dir, ADULTS)), TASK_ID)


@_query
def session_random_extract_three_days(spark, sf_dir):
    drawn = extract.draw_sessions(_matching(spark, sf_dir, THREE_DAYS), seed=TASK_ID)
    return tag_task(extract.extract_rows(drawn, _actions(spark, sf_dir, THREE_DAYS)), TASK_ID)


# --- category and session rankings ----------------------------------------------------------------

@_query
def category_id_counts(spark, sf_dir):
    return rankings.count_category_ids(_actions(spark, sf_dir))


@_query
def category_candidates(spark, sf_dir):
    return rankings.category_candidates(_category_events(spark, sf_dir))


@_query
def category_click_count(spark, sf_dir):
    return rankings.kind_counts(_category_events(spark, sf_dir), "click")


@_query
def category_order_count(spark, sf_dir):
    return rankings.kind_counts(_category_events(spark, sf_dir), "order")


@_query
def category_pay_count(spark, sf_dir):
    return rankings.kind_counts(_category_events(spark, sf_dir), "pay")


@_query
def category_full_count(spark, sf_dir):
    return rankings.category_counts(_category_events(spark, sf_dir))


@_query
def top10_categories(spark, sf_dir):
    counts = rankings.category_counts(_category_events(spark, sf_dir))
    return tag_task(category_result(rankings.top_categories(counts)), TASK_ID)


def _top_category_clicks(spark, sf_dir):
    events = _category_events(spark, sf_dir)
    top = rankings.top_categories(rankings.category_counts(events))
    return rankings.session_category_clicks(events, top)


@_query
def session_category_clicks(spark, sf_dir):
    return _top_category_clicks(spark, sf_dir)


@_query
def top10_sessions(spark, sf_dir):
    top = rankings.top_sessions(_top_category_clicks(spark, sf_dir))
    return tag_task(session_result(top), TASK_ID)


# --- page flow ----------------------------------------------------------------------------------

@_query
def page_pairs(spark, sf_dir):
    return page_flow.page_pairs(page_flow.following_pages(_actions(spark, sf_dir)))


@_query
def page_pair_count(spark, sf_dir):
    return page_flow.page_pair_counts(page_flow.following_pages(_actions(spark, sf_dir)), FLOW)


@_query
def page_convert_rate(spark, sf_dir):
    return page_flow.page_convert_rates(page_flow.following_pages(_actions(spark, sf_dir)), FLOW)


@_query
def page_convert_rate_forward(spark, sf_dir):
    following = page_flow.following_pages(_actions(spark, sf_dir), "asc")
    return page_flow.page_convert_rates(following, FLOW)


@_query
def page_convert_string(spark, sf_dir):
    rates = page_flow.page_convert_rates(page_flow.following_pages(_actions(spark, sf_dir)), FLOW)
    return tag_task(page_flow.page_convert_string(rates, digits=4), TASK_ID)


# --- areas --------------------------------------------------------------------------------------

@_query
def area_click_detail(spark, sf_dir):
    return area.area_click_detail(_clicks(spark, sf_dir), dims.cities(spark))


@_query
def area_product_clicks(spark, sf_dir):
    return area.area_product_clicks(_clicks(spark, sf_dir), dims.cities(spark))


@_query
def area_top3_products(spark, sf_dir):
    return area.top_area_products(area.area_product_clicks(_clicks(spark, sf_dir), dims.cities(spark)))


@_query
def group_concat_distinct(spark, sf_dir):
    detail = area.area_click_detail(_clicks(spark, sf_dir), dims.cities(spark))
    info = sql_functions.concat_long_string(F.col("city_id"), F.col("city_name"))
    return detail.groupBy("area").agg(
        sql_functions.group_concat_distinct(info).alias("city_infos")
    )


# --- ad clicks ----------------------------------------------------------------------------------

@_query
def ad_log_parse(spark, sf_dir):
    return _ads(spark, sf_dir)


@_query
def ad_line_counts(spark, sf_dir):
    return ads.count_ad_lines(fixtures.ad_lines(fixtures.events(spark, sf_dir)))


@_query
def ad_user_daily_clicks(spark, sf_dir):
    return ads.user_day_clicks(_ads(spark, sf_dir))


@_query
def ad_user_click_lookup(spark, sf_dir):
    requests = (
        fixtures.events(spark, sf_dir)
        .selectExpr(
            "date_format(ts, 'yyyyMMdd') AS date",
            "CASE WHEN event_id % 2 = 0 THEN 7L ELSE user_id % 100 END AS userid",
            "event_id % 25 AS adid",
        )
        .distinct()
    )
    counts = ads.user_day_clicks(_ads(spark, sf_dir))
    return ads.lookup_counts(requests, counts, list(ads.USER_KEYS))


@_query
def ad_blacklist_users(spark, sf_dir):
    return ads.over_limit_users(ads.user_day_clicks(_ads(spark, sf_dir)))


@_query
def ad_blacklist_filter(spark, sf_dir):
    return ads.drop_over_limit(_ads(spark, sf_dir))


@_query
def ad_blacklist_replay(spark, sf_dir):
    return ads.replay_blacklist(_ads(spark, sf_dir))


@_query
def ad_province_city_clicks(spark, sf_dir):
    return ads.province_city_clicks(_ads(spark, sf_dir))


@_query
def ad_province_clicks(spark, sf_dir):
    return ads.province_clicks(ads.province_city_clicks(_ads(spark, sf_dir)))


@_query
def ad_province_top3(spark, sf_dir):
    clicks = ads.province_clicks(ads.province_city_clicks(_ads(spark, sf_dir)))
    return ads.top_province_ads(clicks)


@_query
def ad_hour_trend(spark, sf_dir):
    return ads.hour_trend(_ads(spark, sf_dir))


@_query
def ad_sliding_hour(spark, sf_dir):
    return ads.sliding_clicks(_ads(spark, sf_dir))


# --- upserts: the first half of the month, then an overlapping second part ------------------------

def _two_writes(spark, sf_dir, fn: Callable[[DataFrame], DataFrame], since: str) -> DataFrame:
    return upsert.stack_versions(
        fn(_ads(spark, sf_dir, before="2024-01-16 00:00:00")), fn(_ads(spark, sf_dir, since=since))
    )


@_query
def upsert_add(spark, sf_dir):
    writes = _two_writes(spark, sf_dir, ads.user_day_clicks, "2024-01-10 00:00:00")
    return upsert.merge_versions(writes, "add", ads.USER_KEYS, ["click_count"])


@_query
def upsert_overwrite(spark, sf_dir):
    writes = _two_writes(spark, sf_dir, ads.province_city_clicks, "2024-01-10 12:00:00")
    return upsert.merge_versions(writes, "overwrite", ads.CITY_KEYS, ["click_count"])


@_query
def replace_groups(spark, sf_dir):
    def top(clicks: DataFrame) -> DataFrame:
        return ads.top_province_ads(ads.province_clicks(ads.province_city_clicks(clicks)))

    writes = _two_writes(spark, sf_dir, top, "2024-01-10 12:00:00")
    return upsert.merge_versions(
        writes, "replace_groups", ads.PROVINCE_KEYS, ["click_count"], ["date", "province"]
    )


@_query
def insert_distinct(spark, sf_dir):
    def over_limit(clicks: DataFrame) -> DataFrame:
        return ads.over_limit_users(ads.user_day_clicks(clicks), limit=2)

    writes = _two_writes(spark, sf_dir, over_limit, "2024-01-10 00:00:00")
    return upsert.merge_versions(writes, "insert_distinct", ["userid"])


# --- web traffic --------------------------------------------------------------------------------

@_query
def access_log_parse(spark, sf_dir):
    return traffic.render_clicks(_requests(spark, sf_dir))


@_query
def access_line_counts(spark, sf_dir):
    return traffic.count_access_lines(fixtures.access_lines(fixtures.events(spark, sf_dir)))


@_query
def referer_host(spark, sf_dir):
    clicks = traffic.with_search_host(_requests(spark, sf_dir))
    return traffic.render_clicks(clicks).select("time", "course_id", "host")


@_query
def course_daily_clicks(spark, sf_dir):
    return traffic.course_daily(_requests(spark, sf_dir))


@_query
def course_search_clicks(spark, sf_dir):
    return traffic.course_search_daily(_requests(spark, sf_dir))


@_query
def course_counter_lookup(spark, sf_dir):
    requests = (
        fixtures.events(spark, sf_dir)
        .selectExpr(
            "date_format(ts, 'yyyyMMdd') AS day",
            "CAST(128 + event_id % 20 AS INT) AS course_id",
        )
        .distinct()
    )
    found = ads.lookup_counts(
        requests, traffic.course_daily(_requests(spark, sf_dir)), list(traffic.COURSE_KEYS)
    )
    return found.select(traffic.row_key(*traffic.COURSE_KEYS).alias("rowkey"), "click_count")


# Reports read the stored counters, of which they need one day.

def _stored(spark, sf_dir, name: str, count: Callable[[DataFrame], DataFrame]) -> DataFrame:
    return traffic.store_counters(count(_requests(spark, sf_dir)), run_dir(spark, name))


@_query
def course_day_scan(spark, sf_dir):
    return traffic.day_scan(_stored(spark, sf_dir, "courses", traffic.course_daily), REPORT_DAY)


@_query
def course_day_report(spark, sf_dir):
    counters = _stored(spark, sf_dir, "courses", traffic.course_daily)
    return traffic.course_report(counters, dims.courses(spark), REPORT_DAY)


@_query
def course_search_report(spark, sf_dir):
    searches = _stored(spark, sf_dir, "searches", traffic.course_search_daily)
    return traffic.course_search_report(searches, dims.courses(spark), REPORT_DAY)


@_query
def course_day_share(spark, sf_dir):
    return traffic.course_shares(traffic.course_daily(_requests(spark, sf_dir)), dims.courses(spark))


# --- streams: the supplied events as a file stream of three micro-batches, newest days first ------

def _ad_stream_lines(spark, sf_dir, folder):
    return fixtures.ad_lines(fixtures.event_parts(spark, sf_dir, f"{folder}/in"))


def _access_stream_lines(spark, sf_dir, folder):
    return fixtures.access_lines(fixtures.event_parts(spark, sf_dir, f"{folder}/in"))


@_query
def stream_ad_ingest(spark, sf_dir):
    folder = run_dir(spark, "ad-ingest")
    ad_stream.start_ad_ingest(
        _ad_stream_lines(spark, sf_dir, folder), f"{folder}/out", f"{folder}/checkpoint",
        interval=None,
    ).awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def _run_ad_stream(spark, sf_dir, *totals: str) -> ad_stream.AdTables:
    """The clicks query, and those of the totals that are asked for."""
    folder = run_dir(spark, "ad-stream")
    tables = ad_stream.AdTables.at(spark, f"{folder}/tables", compact_every=2)
    lines = _ad_stream_lines(spark, sf_dir, folder)
    ad_stream.run_ad_stream(lines, tables, f"{folder}/checkpoint", totals=totals)
    return tables


@_query
def stream_ad_province_city(spark, sf_dir):
    return _run_ad_stream(spark, sf_dir, "places").city_clicks.read()


@_query
def stream_ad_trend(spark, sf_dir):
    return _run_ad_stream(spark, sf_dir, "minutes").trend.read()


@_query
def stream_ad_last_hour(spark, sf_dir):
    return ads.last_minutes(_run_ad_stream(spark, sf_dir, "minutes").trend.read())


@_query
def stream_ad_province_top3(spark, sf_dir):
    return _run_ad_stream(spark, sf_dir, "places").province_top.read()


@_query
def stream_ad_user_clicks(spark, sf_dir):
    return _run_ad_stream(spark, sf_dir).user_clicks.read()


@_query
def stream_ad_blacklist(spark, sf_dir):
    return _run_ad_stream(spark, sf_dir).blacklist.read()


def _run_traffic_stream(spark, sf_dir) -> traffic_stream.TrafficTables:
    folder = run_dir(spark, "traffic-stream")
    tables = traffic_stream.TrafficTables.at(spark, f"{folder}/tables", compact_every=2)
    traffic_stream.start_traffic_stream(
        _access_stream_lines(spark, sf_dir, folder), tables, f"{folder}/checkpoint", interval=None
    ).awaitTermination()
    return tables


@_query
def stream_course_daily(spark, sf_dir):
    return _run_traffic_stream(spark, sf_dir).courses.read()


@_query
def stream_course_search(spark, sf_dir):
    return _run_traffic_stream(spark, sf_dir).searches.read()
