"""Line streams: a streaming DataFrame with one STRING column ``value``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_lines(
    spark: SparkSession, servers: str, topic: str, starting_offsets: str = "latest", **options: str
) -> DataFrame:
    """Lines of a Kafka topic; offsets are kept in the query's checkpoint.

    Needs the spark-sql-kafka package on the cluster's class path.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .options(**options)
        .load()
        .selectExpr("CAST(value AS STRING) AS value")
    )


def text_lines(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Lines of text files as they appear in a folder."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path).select("value")
