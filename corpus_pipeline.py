"""A training corpus from documents: filter, deduplicate, sanitise, pack.

Each stage takes (spark, docs, sf_dir) and returns what it keeps; ``run`` writes a stage's rows as
Parquet in the shared folder and reads them again as the next one's ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import ngram_join, packing, pii, quality, toxicity
from footfall.llm.text import table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifiers do not reject."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.keep(docs, model).select(*COLUMNS)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine does not call toxic."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep(docs, model).select(*COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, Jaccard 0.8, the smallest id.

    Of equal rows one stays. An id with several texts stands for each of them by itself, as a
    negative number, so that no text is lost. Rows without id are in no group and stay.
    """
    known = docs.where("doc_id IS NOT NULL")
    again = written(known.groupBy("doc_id").count().where("count > 1").select("doc_id"),
                    "repeated-ids")
    own = known.select(*COLUMNS, F.col("doc_id").cast("long").alias("own"),
                       F.lit(False).alias("again"))
    if not again.isEmpty():
        mark = -F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 1) - 1
        own = (known.join(again.withColumn("again", F.lit(True)), "doc_id", "left")
               .select(*COLUMNS, F.when(F.col("again"), mark).otherwise(F.col("doc_id"))
                       .alias("own"), F.col("again").isNotNull().alias("again")))
    named = own.select(F.col("own").alias("doc_id"), "text")
    others = written(ngram_join.components(named, words=5, percent=80)
                     .where("component_id <> doc_id").select(F.col("doc_id").alias("own"))
                     .distinct(), "near-copies")
    # Whole texts are shuffled only where a row may be left out or may be there twice.
    kept = ngram_join.without(own, "own", others)
    kept = kept.where("NOT again").unionByName(kept.where("again").dropDuplicates(["own"]))
    return kept.select(*COLUMNS).unionByName(docs.where("doc_id IS NULL").select(*COLUMNS))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their personal data and the terms that disclose it masked."""
    clean = pii.sanitise(docs, carry=("lang", "source"))
    return clean.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 1024 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality", good_quality), ("toxicity", not_toxic), ("near_copies", one_of_each),
          ("personal_data", without_personal_data), ("packing", packed)]
# Learned classifiers and tokens have no SQL form; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
