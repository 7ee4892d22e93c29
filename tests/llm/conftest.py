from __future__ import annotations

from contextlib import contextmanager

import pytest

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, token string, n long"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text[, lang, source]), with columns whose names clash."""

    def make(*rows: tuple):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s",
                 len(r[1] or ""), "x", 7) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SMALL}/labels.parquet")


# What every operator must take: nulls, empty and long texts, repeated rows, ties.
ODD = (
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "the the the"), (5, "the the the"),
    (6, "word " * 20_000), (None, "no id here"), (7, "x" * 50_000), (8, "<|endoftext|> 中文 é ☃"),
    (9, None, None, None),
)


@pytest.fixture
def odd(docs):
    return docs(*ODD)


@contextmanager
def no_broadcast(spark):
    """Joins as they are for large tables: broadcast only where a hint asks for it."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shuffled(df):
    """Columns and rows of each shuffle that a run of ``df`` makes."""
    df.collect()
    found = []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if name == "Exchange":
            out = node.output()
            found.append(({out.apply(i).name() for i in range(out.size())},
                          node.metrics().apply("shuffleRecordsWritten").value()))
        below = [node.plan()] if name.endswith("QueryStage") else [
            node.children().apply(i) for i in range(node.children().size())]
        for child in below:
            walk(child)

    walk(df._jdf.queryExecution().executedPlan())
    return found
