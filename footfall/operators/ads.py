"""Ad-click statistics. The same functions serve batch tables and micro-batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.parsing import day_key, split_fields
from footfall.operators.ranking import top_per_group
from footfall.session import spread_join

USER_KEYS = ("date", "userid", "adid")
CITY_KEYS = ("date", "province", "city", "adid")
PROVINCE_KEYS = ("date", "province", "adid")
MINUTE_KEYS = ("date", "hour", "minute", "adid")
CLICK_LIMIT = 100
MINUTE_MS = 60_000
# Epoch milliseconds of the years 1 to 9999, the times that can be written as yyyyMMdd.
FIRST_MS, LAST_MS = -62_135_596_800_000, 253_402_300_799_999


def _fields(lines: DataFrame) -> DataFrame:
    return split_fields(lines, " ", {
        "ts_ms": lambda part: part(0).try_cast("bigint"),
        "province": lambda part: part(1),
        "city": lambda part: part(2),
        "userid": lambda part: part(3).try_cast("bigint"),
        "adid": lambda part: part(4).try_cast("bigint"),
    })


def _readable() -> Column:
    return (
        F.coalesce(F.col("ts_ms").between(FIRST_MS, LAST_MS), F.lit(False))
        & F.col("userid").isNotNull()
        & F.col("adid").isNotNull()
    )


def parse_ad_log(lines: DataFrame, keep_malformed: bool = False) -> DataFrame:
    """``epochMillis province city userid adid``.

    Lines that do not fit are dropped, or with ``keep_malformed`` kept as rows of nulls.
    """
    fields = _fields(lines)
    if not keep_malformed:
        return fields.filter(_readable())
    return fields.select(*[F.when(_readable(), F.col(c)).alias(c) for c in fields.columns])


def count_ad_lines(lines: DataFrame) -> DataFrame:
    """How many lines there are, and how many :func:`parse_ad_log` drops."""
    return _fields(lines).agg(
        F.count("*").alias("lines"), F.count_if(~_readable()).alias("malformed")
    )


def _day(ads: DataFrame) -> DataFrame:
    """With the click's day as DATE: cheaper to group by than text, which is made afterwards."""
    return ads.withColumn("date", F.timestamp_millis("ts_ms").cast("date"))


def _text_day(counts: DataFrame) -> DataFrame:
    return counts.withColumn("date", day_key(F.col("date")))


def drop_blacklisted(ads: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Clicks of users that are not blacklisted."""
    return ads.join(blacklist.select("userid"), "userid", "left_anti")


def count_clicks(rows: DataFrame, *keys: str | Column) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("click_count"))


def sum_clicks(counts: DataFrame, *keys: str | Column) -> DataFrame:
    return counts.groupBy(*keys).agg(F.sum("click_count").alias("click_count"))


def user_day_clicks(ads: DataFrame) -> DataFrame:
    return _text_day(count_clicks(_day(ads), *USER_KEYS))


def lookup_counts(requests: DataFrame, counts: DataFrame, keys: list[str]) -> DataFrame:
    """The count of every requested key; 0 for keys without one."""
    return requests.join(counts, keys, "left").withColumn(
        "click_count", F.coalesce("click_count", F.lit(0))
    )


def over_limit_users(totals: DataFrame, limit: int = CLICK_LIMIT) -> DataFrame:
    """Users with more than ``limit`` clicks on one ad in one day."""
    return totals.filter(F.col("click_count") > limit).select("userid").distinct()


def drop_over_limit(ads: DataFrame, limit: int = CLICK_LIMIT) -> DataFrame:
    """Clicks of users that stay within the limit on every day and ad."""
    over = over_limit_users(user_day_clicks(ads), limit)
    return spread_join(ads, over, ["userid"], ["ts_ms"], "left_anti")


def replay_blacklist(ads: DataFrame, limit: int = CLICK_LIMIT) -> DataFrame:
    """Clicks that survive when the log is processed hour by hour.

    A user whose running total on one ad and day exceeds the limit within an hour is blacklisted
    after that hour. Clicks are counted per hour first, so the running sum sees at most
    24 rows per user, ad and day.
    """
    hour = F.date_trunc("hour", F.timestamp_millis("ts_ms"))
    hourly = count_clicks(_day(ads), *USER_KEYS, hour.alias("hour"))
    running = Window.partitionBy(*USER_KEYS).orderBy("hour")
    blocked = (
        hourly.withColumn("total", F.sum("click_count").over(running))
        .filter(F.col("total") > limit)
        .groupBy("userid")
        .agg(F.min("hour").alias("last_hour"))
    )
    return (
        spread_join(ads, blocked, ["userid"], ["ts_ms"], "left")
        .filter(F.col("last_hour").isNull() | (hour <= F.col("last_hour")))
        .select(*ads.columns)
    )


def province_city_clicks(ads: DataFrame) -> DataFrame:
    return _text_day(count_clicks(_day(ads), *CITY_KEYS))


def province_clicks(city_clicks: DataFrame) -> DataFrame:
    """Roll city counts up to provinces."""
    return sum_clicks(city_clicks, *PROVINCE_KEYS)


def top_province_ads(clicks: DataFrame, k: int = 3) -> DataFrame:
    """The most clicked ads of every day and province."""
    return top_per_group(clicks, ["date", "province"], [F.desc("click_count"), F.asc("adid")], k)


def _minute() -> Column:
    return F.floor(F.col("ts_ms") / MINUTE_MS)


def count_minutes(ads: DataFrame, *keys: str) -> DataFrame:
    """Clicks per minute and further keys; the minute as three text columns."""
    return _text_minute(count_clicks(ads, _minute().alias("at"), *keys), *keys)


def _text_minute(counts: DataFrame, *keys: str) -> DataFrame:
    at = F.timestamp_millis(F.col("at") * MINUTE_MS)
    return counts.select(
        F.date_format(at, "yyyyMMdd").alias("date"),
        F.date_format(at, "HH").alias("hour"),
        F.date_format(at, "mm").alias("minute"),
        *keys,
        "click_count",
    )


def minute_clicks(ads: DataFrame) -> DataFrame:
    return count_minutes(ads, "adid")


def last_minutes(trend: DataFrame, minutes: int = 60) -> DataFrame:
    """The last ``minutes`` minutes of a stored minute table, up to its newest one."""
    at = F.unix_seconds(F.try_to_timestamp(F.concat("date", "hour", "minute"),
                                           F.lit("yyyyMMddHHmm"))) / 60
    newest = trend.agg(F.max(at)).scalar()
    return trend.filter(at > newest - minutes)


def hour_trend(ads: DataFrame, minutes: int = 60) -> DataFrame:
    """Clicks per minute and ad over the last ``minutes`` minutes of event time.

    Lines are read and counted once; the newest minute is looked up among the counts.
    """
    counts = ads.groupBy(_minute().alias("at"), "adid").agg(
        F.count("*").alias("click_count"),
        # The group's own minute as an aggregate: a filter on it is not moved below the counting,
        # so both uses of the counts share one shuffle.
        F.max(_minute()).alias("newest"),
    )
    # The count comes along for the same reason: without it the columns differ.
    last = counts.agg(F.max(F.struct("newest", "click_count"))["newest"]).scalar()
    kept = counts.filter(F.col("newest") > last - minutes)
    return _text_minute(kept, "adid")


def slide_changes(ads: DataFrame, length: int, slide: int) -> DataFrame:
    """adid, day, at, change: by how much the sum of ``length`` minutes changes at a window start.

    A count enters the sums with the first window that reaches its slide and leaves them with the
    first that starts after it, so two changes for each count are all that is shuffled.
    """
    step, day = slide * MINUTE_MS, 86_400_000 // (slide * MINUTE_MS)
    counts = count_clicks(ads, F.floor(F.col("ts_ms") / step).alias("slot"), "adid")
    return counts.select("adid", F.inline(F.array(
        F.struct((F.col("slot") - length // slide + 1).alias("at"),
                 F.col("click_count").alias("change")),
        F.struct((F.col("slot") + 1).alias("at"), (-F.col("click_count")).alias("change")),
    ))).groupBy("adid", F.floor(F.col("at") / day).alias("day"), "at").agg(
        F.sum("change").alias("change"))


def sliding_clicks(ads: DataFrame, length: int = 60, slide: int = 1) -> DataFrame:
    """Clicks per ad in every sliding window of ``length`` minutes that starts each ``slide``.

    Clicks are counted per slide, and their changes (:func:`slide_changes`) are summed up within
    days, each day beginning with the sum of the days before, so that an ad's history is not one
    group. A sum holds until the ad's next change.
    """
    if length % slide:
        raise ValueError("a window is a whole number of slides")
    changes = slide_changes(ads, length, slide)
    days = Window.partitionBy("adid").orderBy("day")
    carried = changes.groupBy("adid", "day").agg(
        F.sum("change").alias("change"), F.min("at").alias("first")
    ).select(
        "adid", "day",
        F.coalesce(F.sum("change").over(days.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .alias("before"),
        F.lead("first").over(days).alias("next_first"),
    )
    inside = Window.partitionBy("adid", "day").orderBy("at")
    sums = changes.withColumns({
        "running": F.sum("change").over(inside.rowsBetween(Window.unboundedPreceding, 0)),
        "next_at": F.lead("at").over(inside),
    }).join(carried, ["adid", "day"])
    runs = sums.select(
        "adid", "at", F.coalesce("next_at", "next_first").alias("until"),
        (F.col("before") + F.col("running")).alias("click_count"),
    ).filter(F.col("click_count") > 0)
    starts = F.explode(F.sequence(F.col("at"), F.col("until") - 1))
    return runs.select(starts.alias("at"), "adid", "click_count").select(
        F.date_format(F.timestamp_millis(F.col("at") * (slide * MINUTE_MS)), "yyyy-MM-dd HH:mm")
        .alias("window_start"),
        "adid", "click_count",
    )
