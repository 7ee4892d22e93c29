"""Learned operators: held-out accuracy and defined results for odd rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from footfall.llm import language_id, quality, queries, toxicity
from footfall.llm import terms as M
from footfall.llm.text import fold
from tests.llm.conftest import SMALL

MEDIUM = "/root/testdata/sf0.01"


def _auc(scores, marks):
    order = np.argsort(np.argsort(scores)) + 1
    pos = np.array(marks) == 1
    n1, n0 = pos.sum(), (~pos).sum()
    return (order[pos].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)


@pytest.fixture(scope="module")
def medium(spark):
    read = spark.read.parquet
    return read(f"{MEDIUM}/documents.parquet"), read(f"{MEDIUM}/labels.parquet")


def test_toxicity_of_held_out_rows(spark, medium):
    rows = (queries.op5_toxicity(spark, MEDIUM).join(medium[1], "doc_id")
            .where("held_out").collect())
    # Some toxic rows of this small table hold no insult that its training rows have.
    assert _auc([r.score for r in rows], [r.toxic for r in rows]) > 0.9
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.93


def test_quality_of_held_out_rows(medium):
    docs, labels = medium
    model = quality.fit(docs, labels.where(fold("doc_id", 7) != 0))
    rows = (quality.score(docs, model).join(labels, "doc_id")
            .where(fold("doc_id", 7) == 0).collect())
    assert _auc([r.score for r in rows], [r.quality for r in rows]) > 0.95
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.93
    # Either view is of use by itself.
    for view in ("text_score", "metadata_score"):
        assert _auc([r[view] for r in rows], [r.quality for r in rows]) > 0.8


def test_language_of_held_out_rows(spark, medium):
    rows = (queries.op9_language_id(spark, MEDIUM)
            .join(medium[0].select("doc_id", "lang", "n_chars"), "doc_id")
            .where("held_out AND n_chars > 40").collect())
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.97
    sure = [r for r in rows if not r.rejected]
    assert np.mean([r.lang_pred == r.lang for r in sure]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_learns_from_its_fold_only(spark, medium):
    docs = medium[0]
    changed = docs.withColumn("lang", F.when(fold("doc_id", 4) == 2, "zz").otherwise(F.col("lang")))
    training = fold("doc_id", 4) != 2
    assert language_id.dictionaries(changed, training) == language_id.dictionaries(docs, training)


def test_toxicity_learns_from_its_fold_only(spark, medium):
    docs, labels = medium
    changed = labels.withColumn(
        "toxic", F.when(fold("doc_id", 5) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    models = [toxicity.fit(docs, x, fold("doc_id", 5) != 0) for x in (labels, changed)]
    assert np.array_equal(models[0].machine.w, models[1].machine.w)


def test_odd_documents(spark, odd, medium):
    docs, labels = medium
    contents = language_id.dictionaries(docs, F.lit(True))
    got = {r.doc_id: r for r in language_id.identify(odd, contents).collect()}
    assert {i for i, r in got.items() if r.lang_pred == "und"} == {1, 2, 3, 9}
    assert got[8].lang_pred in contents and got[1].score == 0
    tox = toxicity.score(odd, toxicity.fit(docs, labels))
    assert tox.count() == 11 and tox.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    good = quality.score(odd, quality.fit(docs, labels))
    assert good.count() == 11 and good.where("score IS NULL OR score < 0 OR score > 1").count() == 0


def test_tables_without_rows_or_labels(spark, odd, labels):
    none, unlabelled = odd.limit(0), labels.limit(0)
    for docs in (odd, none):
        for marks in (labels, unlabelled):
            n = docs.count()
            assert toxicity.score(docs, toxicity.fit(docs, marks)).count() == n
            assert quality.score(docs, quality.fit(docs, marks)).count() == n
    # Nothing learned: nothing is rejected.
    assert toxicity.keep(odd, toxicity.fit(odd, unlabelled)).count() == 11
    assert quality.keep(odd, quality.fit(odd, unlabelled)).count() == 11
    contents = language_id.dictionaries(none, F.lit(True))
    assert contents == {}
    assert {r.lang_pred for r in language_id.identify(odd, contents).collect()} == {"und"}


def test_machine_learns_pairs():
    """Class 1 only where both terms stand: linear weights alone cannot tell."""
    rng = np.random.default_rng(3)
    rows, y = [], []
    for _ in range(600):
        a, b = rng.integers(0, 2, 2)
        rows.append(np.array(sorted({0} if a else set()) + sorted({1} if b else set()), np.int64))
        y.append(float(a ^ b))
    machine = M.FactorizationMachine(2, seed=2).fit(M.Rows(rows), np.array(y), np.ones(600), 60)
    assert np.mean((machine.scores(rows) >= 0.5) == np.array(y)) == 1.0
    flat = M.FactorizationMachine(2, factors=0).fit(M.Rows(rows), np.array(y), np.ones(600), 60)
    assert np.mean((flat.scores(rows) >= 0.5) == np.array(y)) < 0.9


def test_views_hand_over_rows(spark):
    """All unlabelled rows take part; each view's surest of either class, as sorting finds them."""
    rng = np.random.default_rng(4)
    values = rng.integers(-900, 900, (300, 2))
    bins = spark.createDataFrame([(i, *map(int, v)) for i, v in enumerate(values)],
                                 "doc_id long, bin0 int, bin1 int")
    features = spark.createDataFrame([(i, [i], [float(i)] * 80) for i in range(300)],
                                     quality.FEATURES)
    handed = quality._handed(features, bins, 0.1, 1000)
    sure = np.log(9) * 64
    for view, (terms, pages, y, weight) in enumerate(handed):
        x = values[:, view]
        top, low = np.sort(x)[::-1][29], np.sort(x)[29]
        for mark, own in ((1, x >= max(top, sure)), (0, x <= min(low, -sure - 1))):
            got = sorted(int(t[0]) for t, m in zip(terms, y, strict=True) if m == mark)
            assert got == np.flatnonzero(own).tolist()
            assert weight[y == mark].sum() == pytest.approx(own.sum() / 300)
        assert [int(p[0]) for p in pages] == [int(t[0]) for t in terms]
    # A bounded fit: fewer rows that weigh as much.
    few = quality._handed(features, bins, 0.1, 5)[0]
    assert len(few[0]) == 10 and few[3].sum() == pytest.approx(handed[0][3].sum())
    assert quality._limits({3: 5, -4: 2}, 10) == (-(2**30), 2**30, 0, 0)


def test_quality_scores_from_features(spark, medium):
    """The query's rows, from features read once, are those of fit and score."""
    docs, labels = (df.limit(200) for df in medium)
    one = {r.doc_id: r.score for r in quality.fit_and_score(docs, labels).collect()}
    two = {r.doc_id: r.score for r in quality.score(docs, quality.fit(docs, labels)).collect()}
    assert one.keys() == two.keys()
    assert all(one[i] == pytest.approx(two[i], abs=1e-9) for i in one)


def test_samples_are_bounded(spark, labels):
    sample = M.labelled(labels, "quality", 3, F.lit(True)).collect()
    assert max(sum(r.y == y for r in sample) for y in (0, 1)) <= 3
    marks = [r.quality for r in labels.collect() if r.quality is not None]
    for y in (0, 1):
        own = [r for r in sample if r.y == y]
        assert sum(r.weight for r in own) == pytest.approx(sum(m == y for m in marks))


def test_letters_of_the_whole_text():
    """Lines of ten characters, the first a capital: every stride of ten meets capitals alone."""
    assert quality.metadata("Aé中 1 - .\n" * 2000, "en", "s")[10:12].tolist() == [1 / 3, 0.3]
    assert quality.metadata("", None, None)[10:12].tolist() == [0, 0]
