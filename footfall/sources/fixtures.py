"""Views over the supplied test tables that have the shape of the jobs' inputs.

The derivations are plain arithmetic on ``events`` and ``customer`` (see FIXTURES.md); each view
is a projection, so it reads every row of its table and adds no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS_SCHEMA = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
    "value DOUBLE, props STRING"
)

# The micro-batches of the checked streams, and the files each is written as.
PARTS = (("2024-01-21", None), ("2024-01-11", "2024-01-21"), (None, "2024-01-11"))
PART_FILES = 2
# Fixed values of the test views.
SPANS = (4, 7, 10, 31, 61, 181, 601, 1801, 3600)
KEYWORDS = (
    "apple iphone", "computer", "ipad", "headset", "Lamer", "deep learning",
    "apple", "spark", "food",
)
PATHS = (
    "class/112.html", "class/128.html", "class/145.html", "class/146.html",
    "class/131.html", "class/130.html", "learn/821", "course/list",
)
REFERERS = (
    "https://www.baidu.com/s?wd=Spark SQL Action",
    "https://www.sogou.com/web?query=Hadoop Framework",
    "https://cn.bing.com/search?q=Storm Action",
    "https://search.yahoo.com/search?p=Spark Streaming Action",
    "https://cn.bing.com/",
    "https://cn.bing.com",
)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def event_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """``events`` as a file stream: the supplied file, or a folder holding parts of it."""
    reader = spark.readStream.schema(EVENTS_SCHEMA).option("pathGlobFilter", "events*.parquet")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def event_parts(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """``events`` as a file stream of three micro-batches, the newest days first."""
    ev = events(spark, sf_dir)
    for since, before in PARTS:
        # Files are taken up in the order in which they were written.
        month(ev, since, before).repartition(PART_FILES).write.mode("append").parquet(folder)
    reader = spark.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", PART_FILES)
    return reader.parquet(folder)


def _pick(values: tuple, index: str) -> str:
    items = ", ".join(f"'{v}'" if isinstance(v, str) else f"{v}L" for v in values)
    return f"element_at(array({items}), CAST({index} AS INT) + 1)"


def visit_actions(ev: DataFrame) -> DataFrame:
    """``user_visit_action`` plus ``event_id``, the order of equal action times.

    Some sessions have no id; some times have single digits, some a zone (unreadable); some lists
    of ordered categories hold an ``x``.
    """
    return (
        ev.selectExpr(
            "*",
            "CAST(datediff(CAST(ts AS DATE), DATE '2024-01-01') AS BIGINT) AS day",
            "CASE user_id % 10 WHEN 0 THEN 30 WHEN 1 THEN 15 WHEN 2 THEN 1 ELSE 5 END AS blk",
        )
        .selectExpr("*", "CAST(floor(day / blk) AS BIGINT) AS bno")
        .selectExpr(
            "*",
            f"event_id * 7919 % {_pick(SPANS, '(user_id + bno) % 9')} AS off",
            "CAST(date_add(DATE '2024-01-01', CAST(bno * blk AS INT)) AS STRING) AS date",
        )
        .selectExpr(
            "date",
            "user_id",
            "CASE WHEN user_id % 50 = 49 AND bno = 0 THEN NULL"
            " ELSE concat('s', user_id, '-', bno) END AS session_id",
            "event_id % 10 AS page_id",
            "CASE event_id % 83"
            " WHEN 1 THEN concat(replace(date, '-0', '-'), ' ', (user_id * 7 + bno * 5) % 23, ':',"
            " CAST(floor(off / 60) AS BIGINT), ':', off % 60)"
            " ELSE concat(date, ' ', lpad((user_id * 7 + bno * 5) % 23, 2, '0'), ':',"
            " lpad(CAST(floor(off / 60) AS BIGINT), 2, '0'), ':', lpad(off % 60, 2, '0'),"
            " CASE WHEN event_id % 83 = 2 THEN ' +05:00' ELSE '' END) END"
            " AS action_time",
            f"CASE WHEN event_type = 'view' THEN {_pick(KEYWORDS, 'event_id % 9')} END"
            " AS search_keyword",
            "CASE WHEN event_type IN ('click', 'error') THEN event_id * event_id % 100 ELSE -1L END"
            " AS click_category_id",
            "CASE WHEN event_type IN ('click', 'error') THEN event_id * 13 % 100 ELSE -1L END"
            " AS click_product_id",
            "CASE WHEN event_type = 'signup' THEN concat(event_id % 100,"
            " CASE WHEN event_id % 3 = 0 THEN concat(',', event_id * 3 % 100) ELSE '' END,"
            " CASE WHEN event_id % 7 = 0 THEN ',x' ELSE '' END) END"
            " AS order_category_ids",
            "CASE WHEN event_type = 'purchase' THEN concat(event_id % 100,"
            " CASE WHEN event_id % 4 = 0 THEN concat(',', event_id * 7 % 100) ELSE '' END) END"
            " AS pay_category_ids",
            "CAST(floor(event_id / 10) AS BIGINT) % 10 AS city_id",
            "event_id",
        )
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``user_info``; a thirteenth of the customers is missing so that the join drops sessions."""
    return (
        spark.read.parquet(f"{sf_dir}/customer.parquet")
        .filter("c_custkey % 13 <> 5")
        .selectExpr(
            "c_custkey AS user_id",
            "concat('user', c_custkey) AS username",
            "c_name AS name",
            "CAST(c_custkey * 7 % 60 AS INT) AS age",
            "concat('professional', c_custkey % 100) AS professional",
            "concat('city', c_nationkey) AS city",
            "CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex",
        )
    )


def ad_lines(ev: DataFrame) -> DataFrame:
    """Ad log lines: epoch milliseconds, province, city, user and ad, joined by blanks.

    Three of 97 cannot be read: no fields, a time beyond the year 9999, a user that is no number.
    """
    return ev.selectExpr(
        "event_id",
        "ts",
        "CASE WHEN event_id % 97 = 5 THEN 'no click' ELSE concat_ws(' ',"
        " CASE WHEN event_id % 97 = 7 THEN 253402300800000 ELSE"
        " unix_millis(CAST(ts AS TIMESTAMP)) END, user_id % 10, user_id % 10,"
        " concat(CASE WHEN event_id % 97 = 6 THEN 'u' ELSE '' END,"
        " CASE WHEN event_id % 2 = 0 THEN 7L ELSE user_id % 100 END),"
        " CASE WHEN event_id % 2 = 0 THEN 1L ELSE event_id % 20 END) END AS value",
    )


def access_lines(ev: DataFrame) -> DataFrame:
    """Tab-separated access log lines; of 89 one has a time with single digits, and three cannot
    be read: a time with a zone, a bare date, a status that is no number."""
    return ev.selectExpr(
        "event_id",
        "concat_ws('\\t', concat('10.0.', user_id % 250, '.', event_id % 250),"
        " CASE event_id % 89 WHEN 1 THEN date_format(ts, 'yyyy-M-d H:m:s')"
        " WHEN 2 THEN concat(date_format(ts, 'yyyy-MM-dd HH:mm:ss'), ' +05:00')"
        " WHEN 3 THEN concat(date_format(ts, 'yyyy-MM-dd'), '        ')"
        " ELSE date_format(ts, 'yyyy-MM-dd HH:mm:ss') END,"
        f" concat('\"GET /', {_pick(PATHS, 'event_id % 8')}, ' HTTP/1.1\"'),"
        " CASE WHEN user_id % 5 = 0 THEN "
        f"{_pick(REFERERS, 'floor(event_id / 8) % 6')} ELSE '-' END,"
        f" CASE WHEN event_id % 89 = 4 THEN 'ok' ELSE {_pick(('200', '404', '500'), 'event_id % 3')}"
        " END) AS value",
    )


def month(ev: DataFrame, since: str | None = None, before: str | None = None) -> DataFrame:
    """The part of ``events`` from one instant up to another."""
    if since:
        ev = ev.filter(F.col("ts") >= F.lit(since).cast("timestamp_ntz"))
    if before:
        ev = ev.filter(F.col("ts") < F.lit(before).cast("timestamp_ntz"))
    return ev
