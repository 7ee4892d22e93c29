"""Course clicks from web access logs, and the reports on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.parsing import (
    action_timestamp, course_id, day_key, referer_host, split_fields,
)

COURSE_KEYS = ("day", "course_id")
SEARCH_KEYS = ("day", "host", "course_id")


def _fields(lines: DataFrame) -> DataFrame:
    return split_fields(lines, "\t", {
        "ip": lambda part: part(0),
        "ts": lambda part: action_timestamp(part(1)),
        "course_id": lambda part: course_id(part(2)),
        "status_code": lambda part: part(4).try_cast("int"),
        "referer": lambda part: part(3),
    })


def _readable() -> Column:
    return (
        F.col("ts").isNotNull() & F.col("course_id").isNotNull()
        & F.col("status_code").isNotNull()
    )


def parse_access_log(lines: DataFrame, keep_malformed: bool = False) -> DataFrame:
    """Class-page requests; requests of other pages are dropped.

    Lines that do not fit are dropped, or with ``keep_malformed`` kept as rows of nulls.
    """
    fields = _fields(lines)
    if not keep_malformed:
        return fields.filter(_readable() & (F.col("course_id") != 0))
    fields = fields.select(*[F.when(_readable(), F.col(c)).alias(c) for c in fields.columns])
    return fields.filter(F.col("course_id").isNull() | (F.col("course_id") != 0))


def count_access_lines(lines: DataFrame) -> DataFrame:
    """How many lines there are, and how many are malformed."""
    return _fields(lines).agg(
        F.count("*").alias("lines"), F.count_if(~_readable()).alias("malformed")
    )


def render_clicks(clicks: DataFrame) -> DataFrame:
    """With the time as text, ``yyyyMMddHHmmss``."""
    return clicks.withColumn("ts", F.date_format("ts", "yyyyMMddHHmmss")).withColumnRenamed("ts", "time")


def count_days(clicks: DataFrame, *keys: str | Column) -> DataFrame:
    """Clicks per day and further keys. Grouped by DATE; the day's text is made afterwards."""
    counts = clicks.groupBy(F.to_date("ts").alias("day"), *keys).agg(
        F.count("*").alias("click_count")
    )
    return counts.withColumn("day", day_key(F.col("day")))


def with_search_host(clicks: DataFrame) -> DataFrame:
    """Clicks that come from another site, with its host."""
    return clicks.withColumn("host", referer_host(F.col("referer"))).filter(
        F.col("host").isNotNull()
    )


def course_daily(clicks: DataFrame) -> DataFrame:
    return count_days(clicks, "course_id")


def course_search_daily(clicks: DataFrame) -> DataFrame:
    return count_days(with_search_host(clicks), "host", "course_id")


def row_key(*keys: str) -> Column:
    """Counter key: the key columns joined by ``_``."""
    return F.concat_ws("_", *keys)


def day_scan(counters: DataFrame, day: str, keys: tuple[str, ...] = COURSE_KEYS) -> DataFrame:
    """Counters of one day by row key. ``day`` is a partition column of the counter tables."""
    return counters.filter(F.col("day") == day).select(
        row_key(*keys).alias("rowkey"), "click_count"
    )


def course_report(counters: DataFrame, courses: DataFrame, day: str) -> DataFrame:
    """A day's clicks by course name; an unknown course has no name."""
    return (
        counters.filter(F.col("day") == day)
        .join(courses, "course_id", "left")
        .select("course_id", "name", "click_count")
    )


def course_search_report(searches: DataFrame, courses: DataFrame, day: str) -> DataFrame:
    """A day's clicks by course and search host, a row for each pair that has any.

    A page that lays courses out against hosts fills its empty cells with zeros itself.
    """
    return (
        searches.filter(F.col("day") == day)
        .join(courses, "course_id", "left")
        .select("course_id", "name", "host", "click_count")
    )


def store_counters(counters: DataFrame, path: str) -> DataFrame:
    """Write counters by day; the returned frame reads only the days that are asked for.

    A day's rows are brought together first, so that a small day is one file.
    """
    rows = counters.hint("rebalance", "day")
    rows.write.mode("overwrite").partitionBy("day").parquet(path)
    return counters.sparkSession.read.schema(counters.schema).parquet(path)


def course_shares(counters: DataFrame, courses: DataFrame) -> DataFrame:
    """Percentage of each course in its day's clicks (one row per course and day goes in)."""
    total = F.sum("click_count").over(Window.partitionBy("day"))
    return (
        counters.withColumn("share", F.round(100 * F.col("click_count") / total, 2))
        .join(courses, "course_id", "left")
        .select("day", "course_id", "name", "click_count", "share")
    )
