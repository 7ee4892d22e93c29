"""Readers of the input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

def user_visit_actions(spark: SparkSession, name: str = "user_visit_action") -> DataFrame:
    """The action fact table; partitioned by ``date``, so date ranges prune partitions."""
    return spark.table(name)


def user_info(spark: SparkSession, name: str = "user_info") -> DataFrame:
    return spark.table(name)

