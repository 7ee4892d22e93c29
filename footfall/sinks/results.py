"""Result tables of the batch jobs."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.session import run_dir
from footfall.sinks.publish import file_system, publish

TASK = "taskid"


def new_task_id() -> str:
    return str(uuid.uuid4())


def tag_task(df: DataFrame, task_id: str) -> DataFrame:
    return df.select(F.lit(task_id).alias(TASK), "*")


@dataclass(frozen=True)
class ResultSink:
    """Where result tables go: a folder per table, or a JDBC database.

    In a folder a task's rows are a folder of their own, which appears as a whole and which a task
    that runs again replaces. ``format="jdbc"`` appends, and takes ``url``, ``user``, ``password`` and so on as options and needs the
    database's driver on the class path.
    """

    format: str = "parquet"
    path: str | None = None
    options: dict[str, str] = field(default_factory=dict)

    def append(self, df: DataFrame, table: str, task_id: str) -> None:
        """Append rows, tagged with the task they belong to."""
        if self.format == "parquet":
            folder = f"{self.path}/{table}/{TASK}={quote(task_id, safe='')}"
            publish(df, folder, replace=True, options=self.options)
            return
        writer = tag_task(df, task_id).write.format(self.format).options(**self.options)
        writer = writer.mode("append")
        if self.format == "jdbc":
            writer.option("dbtable", table).save()
        else:
            writer.save(f"{self.path}/{table}")

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        """The rows of all tasks, the task's id in front."""
        if self.format != "parquet":
            raise ValueError("only result folders are read back")
        rows = spark.read.parquet(f"{self.path}/{table}")
        return rows.select(F.col(TASK).cast("string").alias(TASK), rows.drop(TASK)["*"])


def replace_table(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> None:
    """Replace a managed table.

    The rows are computed and written aside first, so that a computation that fails leaves the old
    ones, and so that they may come from the table itself; replacing it then only copies files.
    """
    spark = df.sparkSession
    aside = f"{run_dir(spark, 'replace')}/rows"
    df.write.parquet(aside)
    writer = spark.read.schema(df.schema).parquet(aside).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    fs, path = file_system(spark, aside)
    fs.delete(path, True)
