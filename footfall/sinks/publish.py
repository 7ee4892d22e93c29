"""Folders that readers see whole or not at all.

Rows go to a hidden folder beside the target, which is then renamed. That needs a file system on which
renaming a folder is one step, as on HDFS or a local disk; object stores have table formats for it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def file_system(spark: SparkSession, folder: str):
    """The folder's file system, and the folder as a path of it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def publish(
    rows: DataFrame, folder: str, partition_by: Sequence[str] = (), replace: bool = False,
    options: Mapping[str, str] | None = None,
) -> bool:
    """Write ``rows`` as ``folder``; says whether it did.

    A folder that is there stays as it is, so that a writer may run again, or with ``replace`` gives
    way once all rows are written. A writer that fails leaves at most a hidden folder behind.
    """
    spark = rows.sparkSession
    fs, path = file_system(spark, folder)
    if fs.exists(path) and not replace:
        return False
    hidden = spark._jvm.org.apache.hadoop.fs.Path(
        path.getParent(), f"_{path.getName()}-{uuid.uuid4().hex}"
    )
    try:
        writer = rows.write.options(**options or {}).partitionBy(*partition_by)
        writer.parquet(hidden.toString())
        if replace:
            fs.delete(path, True)
        if fs.rename(hidden, path):
            return True
        if not fs.exists(path):
            raise OSError(f"{folder} could not be put in place")
        return False  # another writer was first
    finally:
        fs.delete(hidden, True)


def run_together(spark: SparkSession, *jobs: Callable[[], object]) -> None:
    """Run independent writes at the same time; the first error is raised once all have ended."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    for job in running:
        job.result()
