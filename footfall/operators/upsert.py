"""Merging of versioned rows: what a keyed table holds after a sequence of writes.

The input has a ``version`` column; a later write has a higher version. Every mode is an
aggregate or window on the keys, so old and new rows are combined in bulk, by one shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

VERSION = "version"
MODES = ("add", "overwrite", "replace_groups", "insert_distinct")


def stack_versions(*writes: DataFrame) -> DataFrame:
    """Number writes in the order given."""
    numbered = [df.withColumn(VERSION, F.lit(i).cast("bigint")) for i, df in enumerate(writes)]
    return reduce(DataFrame.unionByName, numbered)


def merge_versions(
    df: DataFrame, mode: str, keys: Sequence[str], values: Sequence[str] = (),
    group: Sequence[str] = (),
) -> DataFrame:
    """The rows in force.

    ``add``: values of equal keys are summed. ``overwrite``: the latest write of a key wins.
    ``replace_groups``: the latest write of a group replaces all rows of that group.
    ``insert_distinct``: every key once.
    """
    if mode == "add":
        return df.groupBy(*keys).agg(*[F.sum(v).alias(v) for v in values])
    if mode == "overwrite":
        # A write holds a key at most once, so all values come from the same row.
        return df.groupBy(*keys).agg(*[F.max_by(v, VERSION).alias(v) for v in values])
    if mode == "replace_groups":
        latest = F.max(VERSION).over(Window.partitionBy(*group))
        rows = df.withColumn("latest", latest).filter(F.col(VERSION) == F.col("latest"))
        return rows.select(*keys, *values)
    if mode == "insert_distinct":
        return df.select(*keys).distinct()
    raise ValueError(f"mode is one of {', '.join(MODES)}")
