from __future__ import annotations

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from footfall.sinks.publish import publish, run_together
from tests.helpers import rows


def frame(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v INT")


def test_folder_that_is_there_stays(spark, tmp_path):
    folder = f"{tmp_path}/t"
    assert publish(frame(spark, 1), folder)
    assert not publish(frame(spark, 2), folder)
    assert rows(spark.read.parquet(folder)) == [(1,)]
    assert os.listdir(tmp_path) == ["t"]


def test_replaced_folder(spark, tmp_path):
    folder = f"{tmp_path}/t"
    publish(frame(spark, 1), folder)
    assert publish(spark.read.parquet(folder).unionByName(frame(spark, 2)), folder, replace=True)
    assert rows(spark.read.parquet(folder)) == [(1,), (2,)]


@pytest.mark.parametrize("replace", [False, True])
def test_failed_write_changes_nothing(spark, tmp_path, replace):
    folder = f"{tmp_path}/t"
    if replace:
        publish(frame(spark, 1), folder)
    bad = spark.range(0, 4, 1, 4).select(
        F.when(F.col("id") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("int").alias("v"))
    with pytest.raises(PySparkException):
        publish(bad, folder, replace=replace)
    assert os.listdir(tmp_path) == (["t"] if replace else [])


def test_errors_of_jobs_are_raised(spark, tmp_path):
    def fail():
        raise ValueError("no")

    with pytest.raises(ValueError):
        run_together(spark, fail, lambda: publish(frame(spark, 1), f"{tmp_path}/t"))
    assert os.listdir(tmp_path) == ["t"]
