"""The ad-click stream: blacklist, daily totals, province top lists, minute trend.

Three queries share the work. The clicks query drops what blacklisted users send, adds up clicks per
user, day and ad, and hands the clicks it keeps on, counted per place and per minute; the blacklist
feeds back between its micro-batches, so it looks the touched users' totals up. The places and minutes
queries read what was handed on to them and keep running totals in Spark's state store; what they write
are the totals that changed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from footfall.operators import ads
from footfall.sinks.keyed_table import KeyedTable
from footfall.sinks.publish import file_system, publish, run_together
from footfall.streaming.state import by_kind, of_kind, running_totals, use_state_store

MALFORMED = "source STRING, line_count BIGINT"
PLACES = "date STRING, province STRING, city STRING, adid BIGINT, click_count BIGINT"
MINUTES = "date STRING, hour STRING, minute STRING, adid BIGINT, click_count BIGINT"
USER_BUCKETS = 16
# What the places query keeps in its state.
TOTALS = {"city": ads.CITY_KEYS, "province": ads.PROVINCE_KEYS}


@dataclass(frozen=True)
class AdTables:
    """Result tables of the stream, below one folder."""

    user_clicks: KeyedTable
    blacklist: KeyedTable
    city_clicks: KeyedTable
    province_top: KeyedTable
    trend: KeyedTable
    malformed: KeyedTable
    kept: str

    @staticmethod
    def at(spark: SparkSession, path: str, compact_every: int = 50) -> AdTables:
        def table(name: str, schema: str, mode: str, **more) -> KeyedTable:
            return KeyedTable(
                spark, f"{path}/{name}", schema, mode, compact_every=compact_every, **more
            )

        counted = {"values": ["click_count"]}
        daily = {"partition": "date", **counted}
        return AdTables(
            table("ad_user_click_count", "date STRING, userid BIGINT, adid BIGINT, click_count BIGINT",
                  "add", keys=ads.USER_KEYS, buckets=USER_BUCKETS, bloom="userid", **counted),
            table("ad_blacklist", "userid BIGINT", "insert_distinct", keys=["userid"]),
            table("ad_stat", PLACES, "overwrite", keys=ads.CITY_KEYS, **daily),
            table("ad_province_top3",
                  "date STRING, province STRING, adid BIGINT, click_count BIGINT",
                  "replace_groups", keys=ads.PROVINCE_KEYS, group=["date", "province"], **daily),
            table("ad_click_trend", MINUTES, "overwrite", keys=ads.MINUTE_KEYS, **daily),
            table("ad_malformed", MALFORMED, "add", keys=["source"], values=["line_count"]),
            f"{path}/ad_kept",
        )


def malformed_count(counts: DataFrame, key: str, source: str) -> DataFrame:
    """How many lines could not be read: the count of the row without keys, if there is one."""
    return counts.filter(F.col(key).isNull()).select(
        F.lit(source).alias("source"), F.col("click_count").alias("line_count")
    )


def process_clicks(
    lines: DataFrame, batch_id: int, tables: AdTables, limit: int = ads.CLICK_LIMIT
) -> None:
    """Apply one micro-batch of lines.

    Users blacklisted by earlier batches are dropped; users over the limit with this batch's clicks
    are blacklisted from the next batch on. Users that are listed never get this far, so the list is
    a log of changes. Running the same batch again leaves the same tables.
    """
    parsed = ads.parse_ad_log(lines, keep_malformed=True)
    # The raw batch is read once and counted before any join: all that follows works on
    # these counts, in which a very active user takes no more rows than any other.
    counts = ads.count_minutes(parsed, "province", "city", "userid", "adid")
    counts = ads.drop_blacklisted(counts, tables.blacklist.read(batch_id - 1)).persist()
    try:
        cells = counts.filter(F.col("date").isNotNull())
        clicks = ads.sum_clicks(cells, *ads.USER_KEYS)
        earlier = tables.user_clicks.lookup(clicks, batch_id - 1)
        totals = ads.sum_clicks(earlier.unionByName(clicks), *ads.USER_KEYS)
        hand_on = {"places": ads.CITY_KEYS, "minutes": ads.MINUTE_KEYS}
        run_together(
            lines.sparkSession,
            *[lambda name=name, keys=keys: publish(
                ads.sum_clicks(cells, *keys), f"{tables.kept}/{name}/{batch_id}")
              for name, keys in hand_on.items()],
            lambda: tables.user_clicks.write(clicks, batch_id),
            lambda: tables.blacklist.write(ads.over_limit_users(totals, limit), batch_id),
            lambda: tables.malformed.write(malformed_count(counts, "date", "ad log"), batch_id),
        )
    finally:
        counts.unpersist()


def publish_places(changed: DataFrame, batch_id: int, tables: AdTables, top_k: int = 3) -> None:
    """Write the totals that a micro-batch changed, and the top lists of their provinces.

    Totals only grow, so a list's next state lies in its last one and the changed totals.
    """
    changed = changed.persist()
    try:
        provinces = of_kind(changed, "province", *ads.PROVINCE_KEYS, "click_count")
        groups = provinces.select("date", "province").distinct()
        listed = tables.province_top.read(batch_id - 1).join(
            groups, ["date", "province"], "left_semi"
        )
        newest = listed.unionByName(provinces).groupBy(*ads.PROVINCE_KEYS).agg(
            F.max("click_count").alias("click_count")
        )
        run_together(
            changed.sparkSession,
            lambda: tables.city_clicks.write(
                of_kind(changed, "city", *ads.CITY_KEYS, "click_count"), batch_id),
            lambda: tables.province_top.write(ads.top_province_ads(newest, top_k), batch_id),
        )
    finally:
        changed.unpersist()


def _trigger(interval: str | None) -> dict:
    return {"processingTime": interval} if interval else {"availableNow": True}


def start_clicks(
    lines: DataFrame, tables: AdTables, checkpoint: str,
    interval: str | None = "5 seconds", limit: int = ads.CLICK_LIMIT,
) -> StreamingQuery:
    """The clicks query on a line stream; ``interval=None`` works off what is there."""
    return (
        lines.select("value")
        .writeStream.foreachBatch(lambda df, batch_id: process_clicks(df, batch_id, tables, limit))
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(interval))
        .start()
    )


def _handed_on(spark: SparkSession, tables: AdTables, name: str, schema: str) -> DataFrame:
    """What the clicks query hands on; files go once their micro-batch is done."""
    folder = f"{tables.kept}/{name}"
    fs, path = file_system(spark, folder)
    fs.mkdirs(path)
    return (
        spark.readStream.schema(schema).option("recursiveFileLookup", "true")
        .option("cleanSource", "delete").parquet(folder)
    )


def _start(totals: DataFrame, apply, checkpoint: str, interval: str | None) -> StreamingQuery:
    return (
        totals.writeStream.outputMode("update").foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(interval))
        .start()
    )


def start_places(
    spark: SparkSession, tables: AdTables, checkpoint: str,
    interval: str | None = "5 seconds", top_k: int = 3,
) -> StreamingQuery:
    """The places query: totals by city, and the top lists of the provinces."""
    use_state_store(spark)
    cells = _handed_on(spark, tables, "places", PLACES)
    return _start(
        running_totals(by_kind(cells, TOTALS, "click_count")),
        lambda df, batch_id: publish_places(df, batch_id, tables, top_k), checkpoint, interval,
    )


def start_minutes(
    spark: SparkSession, tables: AdTables, checkpoint: str, interval: str | None = "5 seconds"
) -> StreamingQuery:
    """The minutes query: totals by minute."""
    use_state_store(spark)
    return _start(
        running_totals(_handed_on(spark, tables, "minutes", MINUTES)), tables.trend.write,
        checkpoint, interval,
    )


@dataclass(frozen=True)
class AdStream:
    """The running queries of the stream."""

    queries: tuple[StreamingQuery, ...]

    def stop(self) -> None:
        for query in self.queries:
            query.stop()

    def awaitTermination(self) -> None:
        """Wait until one of them ends, and stop the others; an error is raised."""
        try:
            while all(query.isActive for query in self.queries):
                self.queries[0].awaitTermination(1)
            for query in self.queries:
                if query.exception():
                    raise query.exception()
        finally:
            self.stop()


def start_ad_stream(
    lines: DataFrame, tables: AdTables, checkpoint: str, interval: str = "5 seconds",
    limit: int = ads.CLICK_LIMIT, top_k: int = 3,
) -> AdStream:
    """Run the ad statistics on a line stream."""
    spark = lines.sparkSession
    return AdStream((
        start_clicks(lines, tables, f"{checkpoint}/clicks", interval, limit),
        start_places(spark, tables, f"{checkpoint}/places", interval, top_k),
        start_minutes(spark, tables, f"{checkpoint}/minutes", interval),
    ))


def run_ad_stream(
    lines: DataFrame, tables: AdTables, checkpoint: str, limit: int = ads.CLICK_LIMIT,
    top_k: int = 3, totals: tuple[str, ...] = ("places", "minutes"),
) -> None:
    """Work off what is there, with the totals that are asked for."""
    spark = lines.sparkSession
    start_clicks(lines, tables, f"{checkpoint}/clicks", None, limit).awaitTermination()
    start = {
        "places": lambda at: start_places(spark, tables, at, None, top_k),
        "minutes": lambda at: start_minutes(spark, tables, at, None),
    }
    for query in [start[name](f"{checkpoint}/{name}") for name in totals]:
        query.awaitTermination()


def start_ad_ingest(
    lines: DataFrame, path: str, checkpoint: str, interval: str | None = "5 seconds"
) -> StreamingQuery:
    """Append parsed ad clicks to files; ``interval=None`` works off what is there."""
    return (
        ads.parse_ad_log(lines)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(interval))
        .start()
    )
