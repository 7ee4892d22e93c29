from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from footfall.llm import ngram_join, packing, pii, quality, toxicity
from tests.llm.conftest import SMALL, no_broadcast, shuffled
from tests.llm.test_ngram_join import _by_hand


@pytest.fixture(scope="module")
def stages(spark):
    """What goes into each stage and what comes out of the last."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        out.append(docs.cache())
    return out


def test_registered():
    names = list(__spark_entry__.queries())
    assert [n.split("_")[0] for n in names if n.startswith("op")] == [
        f"op{i}" for i in range(1, 14)]
    assert "pipeline" in names
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality", "toxicity", "near_copies", "personal_data", "packing"]


def test_columns(stages):
    for docs in stages[:-1]:
        assert tuple(docs.columns) == corpus_pipeline.COLUMNS
        assert dict(docs.dtypes) == dict(stages[0].dtypes)


def test_classifiers_decide(spark, stages):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    good = quality.score(stages[0], quality.fit(stages[0], labels)).where("predicted = 1")
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in stages[1].collect()}
    clean = toxicity.score(stages[1], toxicity.fit(stages[1], labels)).where("predicted = 0")
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in stages[2].collect()}
    marks = {r.doc_id: r.toxic for r in labels.collect()}
    kept = [marks[r.doc_id] for r in stages[2].collect() if marks.get(r.doc_id) is not None]
    assert np.mean(kept) < 0.02


def test_one_of_each_group_stays(stages):
    rows = [(r.doc_id, r.text) for r in stages[2].collect()]
    want = [i for i, _, root in _by_hand(rows, 5, 80) if i == root]
    assert sorted(r.doc_id for r in stages[3].collect()) == want


def test_personal_data_is_masked(stages):
    want = {r.doc_id: r.text for r in pii.sanitise(stages[3]).collect()}
    got = {r.doc_id: r for r in stages[4].collect()}
    assert {i: r.text for i, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert not any(pii.base_spans(r.text) for r in got.values())


def test_all_is_packed(spark, stages):
    pieces = stages[5].collect()
    assert {p.doc_id for p in pieces} == {r.doc_id for r in stages[4].collect()}
    ran = corpus_pipeline.run(spark, SMALL)
    assert ran.columns == [f.split()[0] for f in packing.SCHEMA.split(", ")]
    assert sum(p.length for p in pieces) == sum(r.length for r in ran.collect())


def test_rows_without_id_and_repeated_rows(spark, docs):
    text = "one two three four five six seven eight nine ten"
    frame = docs((1, text), (1, text), (2, text), (None, text), (3, None), (4, None)).select(
        *corpus_pipeline.COLUMNS)
    kept = corpus_pipeline.one_of_each(spark, frame, SMALL).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["1", "3", "4", "None"]
    assert corpus_pipeline.one_of_each(spark, frame.limit(0), SMALL).count() == 0
    masked = corpus_pipeline.without_personal_data(spark, frame, SMALL)
    assert masked.count() == 6
    assert ngram_join.components(frame).count() == 6


def test_texts_of_a_repeated_id_are_kept(spark, docs):
    x, y, z = (" ".join(f"{name}{i}" for i in range(30)) for name in "xyz")
    frame = docs((3, x), (5, x), (5, y), (5, y), (6, y + " more"), (7, z), (None, x)).select(
        *corpus_pipeline.COLUMNS)
    kept = corpus_pipeline.one_of_each(spark, frame, SMALL).collect()
    assert sorted(r.text[0] for r in kept if r.doc_id is not None) == ["x", "y", "z"]
    assert {r.doc_id for r in kept} <= {3, 5, 6, 7, None}


def test_few_texts_are_shuffled(spark, documents):
    """The texts that may be left out alone, where no id is repeated."""
    with no_broadcast(spark):
        kept = corpus_pipeline.one_of_each(spark, documents, SMALL)
        rows = sum(n for columns, n in shuffled(kept) if "text" in columns)
    assert rows < documents.count() / 2


def test_short_ids(spark, docs):
    text = " ".join(f"w{i}" for i in range(30))
    frame = docs((1, text), (2, text), (3, "other")).withColumn("doc_id", F.expr("int(doc_id)"))
    kept = corpus_pipeline.one_of_each(spark, frame.select(*corpus_pipeline.COLUMNS), SMALL)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]
