"""Toxicity by a factorization machine over hashed terms.

Terms are the words of a text and their first four and five letters. The machine learns a weight
for each chosen term and, through the terms' factors, one for each pair, so that an insult next to
the mention of a group counts for more than the two apart.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm import terms as M
from footfall.llm import text as T

# Bounds of the fit: labelled rows of each class, and chosen terms. Further terms only tell the
# training rows apart.
SAMPLE_ROWS = 4000
TERMS = 512
# Share of a row's terms left out at random in training, so that one insult alone counts.
DROPPED = 0.2
SCHEMA = "doc_id long, score double, predicted int"
_WORD = re.compile(r"\w+")


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def word_terms(word: str) -> set[str]:
    return {word, *(word[:n] + "*" for n in (4, 5) if len(word) > n)}


def terms_of(text: str) -> set[str]:
    return set().union(*map(word_terms, words_of(text)))


class Model:
    def __init__(self, chosen: np.ndarray, machine: M.FactorizationMachine) -> None:
        self.chosen, self.machine = chosen, machine


def rows_of(texts: list[str], index: M.Index) -> list[np.ndarray]:
    """The numbers of each text's chosen terms."""
    return [np.array(sorted({i for word in words_of(text) for i in index[word]}), np.int64)
            for text in texts]


def fit(docs: DataFrame, labels: DataFrame, training=None, sample_rows: int = SAMPLE_ROWS,
        terms: int = TERMS) -> Model:
    """Learns from at most ``sample_rows`` labelled rows of each class.

    ``training``: a Column over labels that allows rows to be learned from. Without rows of both
    classes every score is the share of toxic rows, or 0.
    """
    sample = M.labelled(labels, "toxic", sample_rows,
                        F.lit(True) if training is None else training)
    known = T.written(M.texts_of(docs, sample), "toxicity-sample")
    chosen = M.telling(known, terms_of, terms)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = M.Index(chosen, word_terms)
        for batch in T.rows(batches):
            yield pa.record_batch(
                [batch.column(0), batch.column(2), batch.column(3),
                 pa.array(rows_of(batch.column(1).to_pylist(), index), pa.list_(pa.int64()))],
                names=["doc_id", "y", "weight", "terms"])

    rows = (known.select("doc_id", "text", "y", "weight")
            .mapInArrow(numbered, "doc_id long, y int, weight double, terms array<long>")
            .orderBy("doc_id").toArrow())
    y = rows.column("y").to_numpy().astype(float)
    machine = M.FactorizationMachine(len(chosen))
    if 0 < y.sum() < len(y):
        sparse = M.Rows([np.array(r, np.int64) for r in rows.column("terms").to_pylist()])
        machine.fit(sparse, y, rows.column("weight").to_numpy(), dropped=DROPPED)
    else:
        machine.w0 = 35.0 if len(y) and y.all() else -35.0
    return Model(chosen, machine)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 from 0.5 on) of every whole text.

    A null or empty text has no terms and gets the score of a text without any; repeated rows are
    scored once each; extra columns are ignored. The model, at most ``TERMS`` terms, goes to every
    task.
    """
    chosen, machine = model.chosen, model.machine

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = M.Index(chosen, word_terms)
        for batch in T.rows(batches):
            values = machine.scores(rows_of(batch.column(1).to_pylist(), index))
            yield pa.record_batch(
                [batch.column(0), pa.array(values, pa.float64()),
                 pa.array((values >= 0.5).astype(np.int32), pa.int32())],
                names=["doc_id", "score", "predicted"])

    return T.texts(docs).mapInArrow(scored, SCHEMA)


def keep(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, that are not predicted toxic."""
    chosen, machine = model.chosen, model.machine

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = M.Index(chosen, word_terms)
        for batch in T.rows(batches):
            texts = [t or "" for t in batch.column(docs_text).to_pylist()]
            yield batch.filter(pa.array(machine.scores(rows_of(texts, index)) < 0.5))

    docs_text = docs.columns.index("text")
    return docs.mapInArrow(kept, docs.schema)
