"""The access-log stream: running clicks per course, and per search host and course.

One streaming aggregate keeps both counters, and the number of unreadable lines, in Spark's state store.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from footfall.functions.parsing import day_key, referer_host
from footfall.operators import traffic
from footfall.sinks.keyed_table import KeyedTable
from footfall.sinks.publish import run_together
from footfall.streaming.ad_stream import MALFORMED
from footfall.streaming.state import by_kind, of_kind, running_totals, use_state_store

TOTALS = {"course": traffic.COURSE_KEYS, "search": traffic.SEARCH_KEYS, "malformed": ()}


@dataclass(frozen=True)
class TrafficTables:
    """Counter tables of the stream, below one folder."""

    courses: KeyedTable
    searches: KeyedTable
    malformed: KeyedTable

    @staticmethod
    def at(spark: SparkSession, path: str, compact_every: int = 50) -> TrafficTables:
        common = {"values": ["click_count"], "partition": "day", "compact_every": compact_every}
        return TrafficTables(
            KeyedTable(
                spark, f"{path}/course_clickcount", "day STRING, course_id INT, click_count BIGINT",
                "overwrite", keys=traffic.COURSE_KEYS, **common,
            ),
            KeyedTable(
                spark, f"{path}/course_search_clickcount",
                "day STRING, host STRING, course_id INT, click_count BIGINT",
                "overwrite", keys=traffic.SEARCH_KEYS, **common,
            ),
            KeyedTable(
                spark, f"{path}/access_log_malformed", MALFORMED, "overwrite", keys=["source"],
                values=["line_count"], compact_every=compact_every,
            ),
        )


def count_lines(lines: DataFrame) -> DataFrame:
    """kind, day, course_id, host, click_count: one row for each line and kind it counts for."""
    parsed = traffic.parse_access_log(lines, keep_malformed=True)
    clicks = parsed.select(
        F.to_date("ts").alias("day"), referer_host(F.col("referer")).alias("host"), "course_id",
        F.lit(1).cast("bigint").alias("click_count"),
    )
    counted = by_kind(clicks, TOTALS, "click_count", "course_id AS read_course", "host AS from_host")
    malformed = F.col("kind") == "malformed"
    unread = F.col("read_course").isNull()
    wanted = (malformed & unread) | (~malformed & ~unread & (
        (F.col("kind") != "search") | F.col("from_host").isNotNull()))
    return counted.filter(wanted).drop("read_course", "from_host")


def publish_totals(changed: DataFrame, batch_id: int, tables: TrafficTables) -> None:
    """Write the counters that a micro-batch changed; earlier ones are not read."""
    changed = changed.withColumn("day", day_key(F.col("day"))).persist()
    unread = of_kind(changed, "malformed", F.lit("access log").alias("source"),
                     F.col("click_count").alias("line_count"))
    try:
        run_together(
            changed.sparkSession,
            lambda: tables.courses.write(
                of_kind(changed, "course", *traffic.COURSE_KEYS, "click_count"), batch_id),
            lambda: tables.searches.write(
                of_kind(changed, "search", *traffic.SEARCH_KEYS, "click_count"), batch_id),
            lambda: tables.malformed.write(unread, batch_id),
        )
    finally:
        changed.unpersist()


def start_traffic_stream(
    lines: DataFrame, tables: TrafficTables, checkpoint: str, interval: str | None = "60 seconds"
) -> StreamingQuery:
    """Run the counters on a line stream; ``interval=None`` works off what is there."""
    use_state_store(lines.sparkSession)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        running_totals(count_lines(lines.select("value")))
        .writeStream.outputMode("update")
        .foreachBatch(lambda df, batch_id: publish_totals(df, batch_id, tables))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
