"""Helpers that several operators share: folds, words, texts of a batch, run folders."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words as the n-gram contract has them: runs of anything but these six white-space characters.
WORDS = re.compile("[^\x20\x09-\x0d]+")
KEPT_WORDS = 100_000  # that a task keeps looked up, some 15 MB
_UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def lower_ascii(text: str) -> str:
    """``text`` with A-Z in lower case; other letters stay."""
    return text.lower() if text.isascii() else text.translate(_UPPER)


def fold(doc_id: str, folds: int) -> Column:
    """The remainder of crc32(doc_id as text) by ``folds``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *columns: str) -> DataFrame:
    """``doc_id``, ``text`` (null: empty) and the named columns; extra columns are left out."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"), *columns)


def rows(batches: Iterator[pa.RecordBatch], size: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches cut to ``size`` rows, which bounds what is held as Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size)


class WordHashes(dict):
    """64-bit hash of each word, kept for the words met lately."""

    def __init__(self, most: int = KEPT_WORDS) -> None:
        super().__init__()
        self.most = most

    def __missing__(self, word: str) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    values = values ^ (values >> np.uint64(30))
    values = values * _MIX[1]
    values = values ^ (values >> np.uint64(27))
    values = values * _MIX[2]
    return values ^ (values >> np.uint64(31))


def chain_hashes(parts: list[np.ndarray]) -> np.ndarray:
    """One hash for each row of equally long arrays, in order of the arrays."""
    out = mix(parts[0] + _MIX[0])
    for part in parts[1:]:
        out = mix((out * _MIX[0]) ^ (part + _MIX[0]))
    return out


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    A local session without that setting gets one below its warehouse.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/shared"
    return folder.rstrip("/")


def written(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """``df`` computed once, as a table in the shared folder; this also cuts its lineage.

    The table goes when the session's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)
