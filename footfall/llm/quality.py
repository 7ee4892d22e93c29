"""Quality by co-training: a classifier of the text and one of the page's metadata.

The text view sees words, marks and how they are written; the metadata view sees language,
source, sizes and layout, and no words. Starting from the same labelled rows, each view marks the
unlabelled rows it is surest of, and these join the other view's training rows, for several
rounds. Both views are then calibrated on labelled rows kept apart, and their calibrated log odds
are added, each weighted by how well it did there.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm import terms as M
from footfall.llm import text as T

# Bounds of the fit: labelled rows of each class, rows with a pseudo-label of each class and view,
# chosen terms. Pseudo-labels themselves come from all unlabelled rows.
SAMPLE_ROWS = 2000
MARKED_ROWS = 1000
TERMS = 2048
ROUNDS = 4
# Share of the unlabelled rows that each view hands over more in each round, and how sure it must be.
HANDED, SURE = 0.1, 0.9
FEATURES = "doc_id long, terms array<int>, page array<double>"
_STEPS = 64  # logit bins for one unit
SCHEMA = "doc_id long, score double, predicted int, text_score double, metadata_score double"
_TOKEN = re.compile(r"\w+|[^\w\s]+")
_BINS = (0.02, 0.05, 0.1, 0.2, 0.4, 0.6, 0.8)


def token_terms(token: str) -> set[str]:
    return {token}


def text_terms(text: str) -> set[str]:
    """Lower-case tokens, and how large the shares of capitals, marks and repetitions are."""
    tokens = _TOKEN.findall(text)
    n = max(1, len(tokens))
    shares = {
        "capitals": sum(map(str.isupper, tokens)) / n,
        "marks": sum(not (t[0].isalnum() or t[0] == "_") for t in tokens) / n,
        "repeated": sum(a == b for a, b in zip(tokens, tokens[2:], strict=False)) / n,
        "doubled": sum(a == b for a, b in zip(tokens, tokens[1:], strict=False)) / n,
        "distinct": len(set(tokens)) / n,
    }
    out = {t.lower() for t in tokens}
    out.update(f"\n{name}>{b}" for name, share in shares.items() for b in _BINS if share > b)
    return out


@lru_cache(1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: is it a letter, is it a capital."""
    return tuple(np.fromiter(map(kind, map(chr, range(0x110000))), bool, 0x110000)
                 for kind in (str.isalpha, str.isupper))


def metadata(text: str, lang: str | None, source: str | None) -> np.ndarray:
    """Sizes, layout, language and source of a page; all about 0 to 1."""
    raw = text.encode()
    lines = text.split("\n")
    n, packed = max(1, len(text)), len(zlib.compress(raw, 1))
    count = {k: sum(map(text.count, marks)) / n for k, marks in
             {"dot": ".", "comma": ",", "bar": "|", "other": "!#$%&*=<>{}[]\\/@^~"}.items()}
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    letters, capitals = (int(np.count_nonzero(kind[codes])) for kind in _letters())
    out = np.zeros(16 + 64)
    out[:13] = (
        1, min(1, np.log1p(n) / 12), min(1.5, packed / max(1, len(raw))),
        min(1, np.log1p(len(lines)) / 8), min(1, np.log1p(n / len(lines)) / 8),
        len(set(lines)) / len(lines), min(1, 20 * count["dot"]), min(1, 20 * count["comma"]),
        min(1, 20 * count["bar"]), min(1, 20 * count["other"]), capitals / max(1, letters),
        letters / n, len(raw) / n / 4)
    out[16 + zlib.crc32(b"l" + (lang or "").encode()) % 16] = 1
    out[32 + zlib.crc32(b"s" + (source or "").encode()) % 48] = 1
    return out


class _Dense:
    """Logistic regression on dense rows, by gradient steps with decreasing rate."""

    def __init__(self, width: int) -> None:
        self.w = np.zeros(width)
        self.mean, self.scale = np.zeros(width), np.ones(width)

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 400,
            decay: float = 1e-3) -> _Dense:
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-2
        self.mean[0], self.scale[0] = 0, 1  # the constant
        z = (x - self.mean) / self.scale
        weight = weight / weight.sum()
        self.w[:] = 0
        moved = np.full(x.shape[1], 1e-8)
        for _ in range(steps):
            step = z.T @ (weight * (M.sigmoid(z @ self.w) - y)) + decay * self.w
            moved += step ** 2
            self.w -= 0.5 * step / np.sqrt(moved)
        return self

    def logits(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.w


class _Sparse:
    """Logistic regression on chosen terms: a factorization machine without factors."""

    def __init__(self, terms: int) -> None:
        self.machine = M.FactorizationMachine(terms, factors=0)

    def fit(self, rows: list[np.ndarray], y: np.ndarray, weight: np.ndarray) -> _Sparse:
        self.machine = M.FactorizationMachine(len(self.machine.w), factors=0)
        self.machine.fit(M.Rows(rows), y, weight, epochs=15)
        return self

    def logits(self, rows: list[np.ndarray]) -> np.ndarray:
        sparse = M.Rows(rows)
        at, owner = sparse.part(np.arange(len(rows)))
        return self.machine.logits(at, owner, len(rows))[0]


class Model:
    """Both views, the scale and shift that calibrate each, and each one's weight."""

    def __init__(self, chosen: np.ndarray, prior: float) -> None:
        self.chosen, self.prior = chosen, prior
        self.text, self.page = _Sparse(len(chosen)), _Dense(80)
        self.calibration = [(1.0, 0.0), (1.0, 0.0)]
        self.weights = [0.5, 0.5]
        self.fitted = False

    def scores(self, rows: list[np.ndarray], pages: np.ndarray) -> np.ndarray:
        """[view, row], the combined view last."""
        if not self.fitted:
            return np.full((3, len(rows)), self.prior)
        found = [a * x + b for x, (a, b) in zip(
            (self.text.logits(rows), self.page.logits(pages)), self.calibration, strict=True)]
        both = self.weights[0] * found[0] + self.weights[1] * found[1]
        return M.sigmoid(np.array([*found, both]))


def _index(chosen: np.ndarray):
    number = {int(t): i for i, t in enumerate(chosen)}
    known: dict[str, int] = {}

    def rows(text: str) -> np.ndarray:
        out = set()
        for term in text_terms(text):
            at = known.get(term)
            if at is None:
                if len(known) >= T.KEPT_WORDS:
                    known.clear()
                at = known[term] = number.get(M._hash(term), -1)
            out.add(at)
        return np.array(sorted(out - {-1}), np.int64)

    return rows


def _platt(logits: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float, float]:
    """Scale and shift that make the logits' probabilities fit, and the loss then.

    Labels are softened as if each class had one row more of either kind.
    """
    n1, n0 = y.sum(), len(y) - y.sum()
    soft = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = weight / weight.sum()
    x = np.clip(logits, -20, 20)
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton steps
        p = M.sigmoid(a * x + b)
        g = np.array([(weight * (p - soft) * x).sum() + 1e-4 * (a - 1), (weight * (p - soft)).sum()])
        h = weight * p * (1 - p)
        hessian = np.array([[(h * x * x).sum() + 1e-4, (h * x).sum()],
                            [(h * x).sum(), h.sum() + 1e-6]])
        a, b = np.array([a, b]) - np.clip(np.linalg.solve(hessian, g), -1, 1)
        a = max(a, 0.05)
    p = np.clip(M.sigmoid(a * x + b), 1e-6, 1 - 1e-6)
    return a, b, float(-(weight * (soft * np.log(p) + (1 - soft) * np.log(1 - p))).sum())


def _limits(counts: dict[int, int], most: float) -> tuple[int, int, int, int]:
    """The bins of logits that one view hands over: up to which for class 0, from which for class 1,
    and how many rows each has. Whole bins are taken, the surest first, until ``most`` are."""
    sure = int(np.ceil(np.log(SURE / (1 - SURE)) * _STEPS))
    out = []
    for order, able in ((sorted(counts), lambda x: x < -sure),
                        (sorted(counts, reverse=True), lambda x: x >= sure)):
        last, taken = None, 0
        for x in order:
            if taken >= most or not able(x):
                break
            last, taken = x, taken + counts[x]
        out.append((last, taken))
    (low, n0), (high, n1) = out
    return -(2**30) if low is None else low, 2**30 if high is None else high, n0, n1


def _features(docs: DataFrame, chosen: np.ndarray) -> DataFrame:
    """doc_id, numbers of the chosen terms and page metadata of every row, computed once."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(chosen)
        for batch in T.rows(batches):
            texts, langs, sources = (batch.column(i).to_pylist() for i in (1, 2, 3))
            pages = [metadata(*r) for r in zip(texts, langs, sources, strict=True)]
            yield pa.record_batch(
                [batch.column(0), pa.array([index(t) for t in texts], pa.list_(pa.int32())),
                 pa.array(pages, pa.list_(pa.float64()))], names=["doc_id", "terms", "page"])

    return T.written(T.texts(docs, "lang", "source").mapInArrow(found, FEATURES),
                     "quality-features", "zstd")


def _arrays(batch, at: int) -> list[np.ndarray]:
    """The lists of a column of numbers."""
    column = batch.column(at)
    values, ends = column.flatten().to_numpy(), np.cumsum(pa.compute.list_value_length(column))
    return np.split(values, ends[:-1]) if len(ends) else []


def _unlabelled_bins(features: DataFrame, labels: DataFrame, model: Model) -> DataFrame:
    """doc_id and the bin of either view's logit of every unlabelled id; an id with several rows
    has its least ones."""

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.rows(batches, 2048):
            pages = np.array(_arrays(batch, 2)).reshape(batch.num_rows, 80)
            logits = (model.text.logits(_arrays(batch, 1)), model.page.logits(pages))
            yield pa.record_batch(
                [batch.column(0), *(pa.array(np.floor(np.clip(x, -35, 35) * _STEPS), pa.int32())
                                    for x in logits)], names=["doc_id", "bin0", "bin1"])

    return (features.where("doc_id IS NOT NULL")
            .mapInArrow(binned, "doc_id long, bin0 int, bin1 int")
            .groupBy("doc_id").agg(F.min("bin0").alias("bin0"), F.min("bin1").alias("bin1"))
            .join(labels.select(F.col("doc_id").cast("long").alias("doc_id")), "doc_id",
                  "left_anti"))


def _handed(features: DataFrame, bins: DataFrame, share: float, most: int) -> list[tuple]:
    """For each view the rows it hands over: terms, pages, pseudo-labels and weights.

    Of all unlabelled rows each view hands over its surest, ``share`` of them in each class. At
    most ``most`` a class, by the hash of their ids, are returned; their weights add up to the
    share that was handed over.
    """
    counts: list[dict[int, int]] = [{}, {}]
    for view in (0, 1):  # at most 70 units of logit, so a bounded number of bins
        for r in bins.groupBy(F.col(f"bin{view}").alias("bin")).count().collect():
            counts[view][r.bin] = r["count"]
    total = sum(counts[0].values())
    limits = [_limits(c, share * total) for c in counts]
    marks = [F.when(F.col(f"bin{v}") <= limits[v][0], 0).when(F.col(f"bin{v}") >= limits[v][1], 1)
             for v in (0, 1)]
    first = Window.partitionBy("view", "y").orderBy(F.xxhash64("doc_id"), "doc_id")
    picked = (bins.select("doc_id", F.posexplode(F.array(*marks)).alias("view", "y"))
              .where("y IS NOT NULL").withColumn("place", F.row_number().over(first))
              .where(F.col("place") <= most).select("doc_id", "view", "y"))
    rows = (features.join(F.broadcast(picked.select("doc_id").distinct()), "doc_id", "left_semi")
            .groupBy("doc_id").agg(F.min(F.struct("terms", "page")).alias("r"))
            .join(picked, "doc_id").select("doc_id", "view", "y", "r.terms", "r.page")
            .orderBy("view", "y", "doc_id").toArrow().combine_chunks())
    view, y = (rows.column(c).to_numpy() for c in ("view", "y"))
    terms = [np.array(r, np.int64) for r in rows.column("terms").to_pylist()]
    pages = np.array(rows.column("page").to_pylist()).reshape(len(y), 80)
    out = []
    for v in (0, 1):
        own = np.flatnonzero(view == v)
        parts = [limits[v][2 + c] / max(1, (y[own] == c).sum()) / max(1, total) for c in (0, 1)]
        out.append(([terms[i] for i in own], pages[own], y[own].astype(float),
                    np.array([parts[c] for c in y[own]], float)))
    return out


def cotrain(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS,
            marked_rows: int = MARKED_ROWS, terms: int = TERMS,
            rounds: int = ROUNDS) -> tuple[Model, DataFrame]:
    """The model of :func:`fit`, and the features of all rows of ``docs`` that it was made with."""
    known = T.written(
        M.texts_of(docs, M.labelled(labels, "quality", sample_rows, F.lit(True)), "lang", "source"),
        "quality-sample")
    known = known.withColumn("fold", T.fold("doc_id", 5))
    chosen = M.telling(known.where("fold <> 0"), text_terms, terms)
    features = _features(docs, chosen)
    found = (_features(known, chosen).join(known.select("doc_id", "y", "weight", "fold"), "doc_id")
             .orderBy("doc_id").toArrow())
    y = found.column("y").to_numpy().astype(float)
    fold = found.column("fold").to_numpy()
    weight = found.column("weight").to_numpy()
    learned, kept = np.flatnonzero(fold != 0), np.flatnonzero(fold == 0)
    model = Model(chosen, float(y.mean() >= 0.5) if len(y) else 1.0)
    if len(set(y[learned])) < 2:
        return model, features
    model.fitted = True
    all_terms = [np.array(r, np.int64) for r in found.column("terms").to_pylist()]
    pages = np.array(found.column("page").to_pylist())
    handed = [([], np.empty((0, 80)), np.empty(0), np.empty(0))] * 2
    for turn in range(rounds + 1):
        if turn:
            bins = T.written(_unlabelled_bins(features, labels, model), "quality-bins")
            handed = _handed(features, bins, turn * HANDED / 2, marked_rows)
        # Each view learns the labelled rows and what the other one has handed over.
        (own_terms, _, y_text, w_text), (_, own_pages, y_page, w_page) = handed[1], handed[0]
        scale = weight[learned].sum()
        model.text.fit([*(all_terms[i] for i in learned), *own_terms],
                       np.concatenate([y[learned], y_text]),
                       np.concatenate([weight[learned], scale * w_text]))
        model.page.fit(np.concatenate([pages[learned], own_pages]),
                       np.concatenate([y[learned], y_page]),
                       np.concatenate([weight[learned], scale * w_page]))
    # Without both classes apart, the learned rows themselves calibrate.
    fair = kept if len(set(y[kept])) == 2 else learned
    losses = []
    for view, logits in enumerate((model.text.logits(all_terms), model.page.logits(pages))):
        a, b, loss = _platt(logits[fair], y[fair], weight[fair])
        model.calibration[view] = (a, b)
        losses.append(loss + 1e-3)
    total = sum(1 / x for x in losses)
    model.weights = [1 / x / total for x in losses]
    return model, features


def fit(docs: DataFrame, labels: DataFrame, **bounds: int) -> Model:
    """Co-trains both views on at most ``sample_rows`` labelled rows of each class and on
    pseudo-labels of all unlabelled rows of ``docs``.

    In each round all unlabelled rows are scored; in round r each view hands over the r * 5 % of
    them that it is surest of in either class, marked anew each time. The other view learns a
    bounded sample of these (``marked_rows`` a class), weighted by the share handed over, so the
    fit is alike at every size. Labelled rows whose crc32(doc_id as text) mod 5 is 0 calibrate the
    views. Without rows of both classes every score is 1 (keep) if no row is labelled, else the
    only class seen.
    """
    return cotrain(docs, labels, **bounds)[0]


def fit_and_score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """:func:`score` of ``docs`` by the model fitted on them; each text is read for its terms once."""
    model, features = cotrain(docs, labels)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.rows(batches):
            pages = np.array(_arrays(batch, 2)).reshape(batch.num_rows, 80)
            yield _result(batch.column(0), model.scores(_arrays(batch, 1), pages))

    return features.mapInArrow(scored, SCHEMA)


def _result(ids: pa.Array, scores: np.ndarray) -> pa.RecordBatch:
    by_text, by_page, both = scores
    return pa.record_batch(
        [ids, pa.array(both, pa.float64()), pa.array((both >= 0.5).astype(np.int32), pa.int32()),
         pa.array(by_text, pa.float64()), pa.array(by_page, pa.float64())],
        names=[f.split()[0] for f in SCHEMA.split(", ")])


def _scores(model: Model, index, batch: pa.RecordBatch, at: tuple[int, ...]) -> np.ndarray:
    """All scores of a batch; ``at``: the places of text, language and source."""
    texts, langs, sources = (batch.column(i).to_pylist() for i in at)
    texts = [t or "" for t in texts]
    pages = np.array([metadata(*r) for r in zip(texts, langs, sources, strict=True)])
    return model.scores([index(t) for t in texts], pages.reshape(len(texts), 80))


def keep(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, that are predicted good."""
    at = tuple(map(docs.columns.index, ("text", "lang", "source")))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(model.chosen)
        for batch in T.rows(batches):
            yield batch.filter(pa.array(_scores(model, index, batch, at)[2] >= 0.5))

    return docs.mapInArrow(kept, docs.schema)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1), predicted (1: good, from 0.5 on) and either view's score.

    A null text counts as empty; null language or source are values of their own; repeated rows
    are scored once each; extra columns are ignored. The model, at most ``TERMS`` terms, goes to
    every task.
    """

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(model.chosen)
        for batch in T.rows(batches):
            yield _result(batch.column(0), _scores(model, index, batch, (1, 2, 3)))

    return T.texts(docs, "lang", "source").mapInArrow(scored, SCHEMA)
