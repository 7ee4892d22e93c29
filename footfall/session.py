"""Session settings and the shared folder for state that must outlive an executor."""

from __future__ import annotations

import uuid
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The one setting that results depend on: day and minute keys are cut from epoch milliseconds
# in the session's zone. All else is the cluster's.
RUNTIME_SETTINGS = {"spark.sql.session.timeZone": "UTC"}
# Parts that the rows of one key are dealt into by :func:`spread_join`.
SALTS = 32


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str, **settings: str) -> SparkSession:
    """Session for ``spark-submit``; the master comes from the submit command."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a session on this machine alone may do without; it uses a folder below its warehouse.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/shared"
    return folder.rstrip("/")


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run below the shared folder; it goes when the session's JVM ends."""
    folder = f"{shared_dir(spark)}/footfall/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return folder


def spread_join(rows: DataFrame, side: DataFrame, keys: list[str], by: list[str], how: str,
                salts: int = SALTS) -> DataFrame:
    """Join on ``keys``, nulls being equal, with the rows of each key dealt into ``salts`` parts.

    The part is a hash of the columns ``by``, and ``side``, which has each key at most once, is
    copied once for each part; so no key's rows meet in one task, whatever the sizes are.
    """
    part = F.pmod(F.hash(*by), F.lit(salts))
    copies = side.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    copies = copies.withColumnsRenamed({key: f"_{key}" for key in keys})
    same: list[Column] = [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys]
    dealt = rows.withColumn("_own_part", part)
    joined = dealt.join(copies, reduce(and_, same, F.col("_own_part") == F.col("_part")), how)
    return joined.drop("_own_part", "_part", *(f"_{key}" for key in keys))
