"""One query for each operator of this package, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import (
    divergence,
    language_id,
    license_scan,
    ngram_join,
    packing,
    pii,
    prefix_trie,
    quality,
    spotsigs,
    sql,
    topk,
    toxicity,
    vantage,
    word_tokens,
)
from footfall.llm.text import fold, table

BYTE_TOKENS = "byte_bpe_50k.json"
WORD_TOKENS = "word_bpe_49k.json"


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_TOKENS))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op3_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.edited_fingerprints(table(spark, sf_dir, "documents"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = word_tokens.encode(table(spark, sf_dir, "documents"),
                                 public_tokenizers.path(WORD_TOKENS))
    return encoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                          F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score",
        "predicted")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.sanitise(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone",
        F.sha2("base", 256).alias("base_sha256"), "spans")


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.components(table(spark, sf_dir, "documents"), words=3, percent=90)


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    contents = language_id.dictionaries(docs, fold("doc_id", 4) != 2)
    return language_id.identify(docs, contents).select(
        "doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        "lang_pred", "score", "margin", "rejected")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.fit_and_score(docs, table(spark, sf_dir, "labels"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_vantage_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return vantage.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_packing, op2_license_scan, op3_spotsigs, op4_bpe, op5_toxicity, op6_pii,
        op7_ngram_join, op8_topk, op9_language_id, op10_quality, op11_source_divergence,
        op12_vantage_points, op13_prefix_trie, pipeline)}


# SQL for op8: a floor of 1024 times each component, the exact inner products, the ten highest.
_TOP_K = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE))
                                                           AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT)
               AS score
    FROM whole q JOIN whole c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
    WHERE q.vec_id % 100 = 0),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n
    FROM scored)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM ranked WHERE n <= 10
"""

# SQL for op7: all pairs of distinct shingle sets, then the smallest id reachable by links.
_NGRAM_JOIN = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents),
sets AS (
    SELECT doc_id, CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 1),
             lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) END AS s
    FROM words),
classes AS (SELECT s, min(doc_id) AS class_id, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
items AS (SELECT class_id, n, unnest(s) AS shingle FROM classes),
links AS (
    SELECT a.class_id AS x, b.class_id AS y
    FROM items a JOIN items b ON a.shingle = b.shingle AND a.class_id <> b.class_id
         AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
    GROUP BY a.class_id, a.n, b.class_id, b.n
    HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach AS (
    SELECT class_id AS x, class_id AS y FROM classes
    UNION
    SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
lowest AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT sets.doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles,
       coalesce(lowest.component_id, sets.doc_id) AS component_id
FROM sets LEFT JOIN classes ON sets.s = classes.s LEFT JOIN lowest ON lowest.x = classes.class_id
"""


def oracle_sql() -> dict[str, str]:
    """SQL for the queries whose rows SQL can give; the others are held against brute force."""
    return {"op7_ngram_join": _NGRAM_JOIN, "op8_topk": _TOP_K,
            "op11_source_divergence": sql.SOURCE_DIVERGENCE, "op13_prefix_trie": sql.PREFIX_TRIE}
