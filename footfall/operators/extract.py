"""Stratified random extraction of sessions by the hour they start in."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.parsing import blank_to_null, format_time
from footfall.operators.sessions import category_list, keyword_list


def _with_hour(sessions: DataFrame) -> DataFrame:
    """Sessions by the hour they start in; one without a readable time starts in none."""
    return sessions.filter(F.col("start_time").isNotNull()).select(
        "session_id",
        "start_time",
        F.date_format("start_time", "yyyy-MM-dd").alias("date"),
        F.hour("start_time").alias("hour"),
    )


def hour_counts(sessions: DataFrame) -> DataFrame:
    return _with_hour(sessions).groupBy("date", "hour").agg(F.count("*").alias("hour_count"))


def extract_quotas(sessions: DataFrame, total: int = 100) -> DataFrame:
    """Rows to draw per hour: the day's equal share of ``total``, split by the hour's weight.

    The window runs over a day's hour counts, the number of days is a value of its own.
    """
    counts = hour_counts(sessions)
    days = counts.agg(F.count_distinct("date")).scalar()
    counts = counts.withColumn("day_count", F.sum("hour_count").over(Window.partitionBy("date")))
    counts = counts.withColumn("extract_per_day", F.floor(F.lit(total) / days))
    share = F.floor(F.col("hour_count") / F.col("day_count") * F.col("extract_per_day"))
    return counts.withColumn("quota", F.least("hour_count", share))


def draw_sessions(sessions: DataFrame, total: int = 100, seed: str = "0") -> DataFrame:
    """Draw each hour's quota uniformly without replacement; the same seed draws the same rows.

    Sessions are ranked by a hash of their id (no id counts as an empty one). The hashes' first
    three digits are counted first: they tell up to which of 4096 ranges an hour's
    quota reaches, and only sessions in these ranges are ranked. An hour of any size thus
    sends its quota and the rest of one range.
    """
    hashed = _with_hour(sessions).withColumn(
        "hash", F.md5(F.concat(F.coalesce("session_id", F.lit("")), F.lit(seed)))
    ).withColumn("range", F.substring("hash", 1, 3))
    quotas = extract_quotas(sessions, total).select("date", "hour", "quota")
    up_to = Window.partitionBy("date", "hour").orderBy("range")
    cuts = (
        hashed.groupBy("date", "hour", "range").agg(F.count("*").alias("n"))
        .withColumn("before", F.sum("n").over(up_to) - F.col("n"))
        .join(quotas, ["date", "hour"])
        .filter(F.col("before") < F.col("quota"))
        .groupBy("date", "hour", "quota").agg(F.max("range").alias("last_range"))
    )
    by_hash = Window.partitionBy("date", "hour").orderBy("hash", "session_id")
    return (
        hashed.join(cuts, ["date", "hour"])
        .filter(F.col("range") <= F.col("last_range"))
        .withColumn("rank", F.row_number().over(by_hash))
        .filter(F.col("rank") <= F.col("quota"))
        .select("session_id", "start_time")
    )


def extract_rows(drawn: DataFrame, actions: DataFrame) -> DataFrame:
    """Result rows of the drawn sessions.

    Keyword and category lists, which are published as text, are collected for the drawn
    sessions alone. Their distinct values are found before anything is collected.
    """
    ids = drawn.select(F.col("session_id").alias("drawn_id"), "start_time")
    return (
        actions.join(ids, F.col("session_id").eqNullSafe(F.col("drawn_id")))
        .select("session_id", "start_time", "search_keyword", "click_category_id").distinct()
        .groupBy("session_id", "start_time")
        .agg(keyword_list().alias("keywords"), category_list().alias("categories"))
        .select(
            F.col("session_id").alias("sessionid"),
            format_time(F.col("start_time")).alias("startTime"),
            blank_to_null(F.array_join("keywords", ",")).alias("searchKeywords"),
            blank_to_null(
                F.array_join(F.col("categories").cast("array<string>"), ",")
            ).alias("clickCategoryIds"),
        )
    )
