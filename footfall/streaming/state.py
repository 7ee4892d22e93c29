"""Running totals in Spark's state store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# State lives on the executors' disks, and a checkpoint holds what changed, not the whole state.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def use_state_store(spark: SparkSession) -> None:
    """Settings of queries that are started from here on; those of the session come first."""
    for key, value in STATE_SETTINGS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def by_kind(rows: DataFrame, kinds: dict[str, tuple[str, ...]], *others: str) -> DataFrame:
    """Each row once for each kind of total, with that kind's keys and nulls for the other keys.

    ``others`` are further columns, as SQL.
    """
    keys = list(dict.fromkeys(k for own in kinds.values() for k in own))
    types = dict(rows.dtypes)
    cells = [
        F.struct(F.lit(kind).alias("kind"), *[
            (F.col(k) if k in own else F.lit(None).cast(types[k])).alias(k) for k in keys
        ])
        for kind, own in kinds.items()
    ]
    return rows.select(F.inline(F.array(*cells)), *[F.expr(other) for other in others])


def running_totals(rows: DataFrame) -> DataFrame:
    """A stream of :func:`by_kind` rows with ``click_count``, added up since the stream began.

    In update mode each micro-batch yields the keys it changed. Nothing is ever dropped from the
    state, so that late rows count.
    """
    keys = [c for c in rows.columns if c != "click_count"]
    return rows.groupBy(*keys).agg(F.sum("click_count").alias("click_count"))


def of_kind(totals: DataFrame, kind: str, *columns: str) -> DataFrame:
    return totals.filter(F.col("kind") == kind).select(*columns)
