"""Top rows per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows of every group.

    Spark keeps only ``k`` rows per group in each map task before it shuffles
    (WindowGroupLimit), so a large group does not load one task.
    """
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.filter(F.col("rank") <= k).drop("rank")
