"""How the sources of a language diverge: in all terms pairwise, and in the terms each overuses.

The terms that tell most of a group (lang, source) come from a dominance skyband. One term dominates
another if its count in the group is not lower, its count in the language not higher and its UTF-8
earlier: it then ranks before it, whatever the totals are. Terms are dealt into parts; each keeps
those that fewer than k others dominate, and the kept ones of all parts are thinned the same way
before what is left is ranked by exact values. A part is read in an order in which no term follows
one that it dominates, so only the kept terms are held.

Sources are compared pair by pair over blocks of sources and parts of the vocabulary. A part adds
up how far each pair's terms there lie from two terms that neither source has; the rest of the
vocabulary is one multiplication.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm import text as T

TOP = 10  # terms published of a group
DOCUMENTS = 10  # of a language that a kept term occurs in
SCALE = 1_000_000_000
PARTS = 16  # of a group's terms, each with a skyband of its own
HELD = 200_000  # counters of a task before it hands them on
BLOCK = 128  # sources that are compared with so many others at a time
TERMS = 1024  # of a block that are compared at a time
SCHEMA = "lang string, source string, part string, item string, value long, rank int"

# Bytes of terms, A-Z in lower case; all others part them. Bytes from 128 on belong to letters
# beyond ASCII, which are all kept.
_FOLDED = bytes((b + 32 if 65 <= b <= 90 else b) if 65 <= b <= 90 or 97 <= b <= 122 or b >= 128
                else 32 for b in range(256))


def terms(raw: bytes) -> list[bytes]:
    """The terms of a UTF-8 text in order: runs of letters, A-Z in lower case."""
    return raw.translate(_FOLDED).split()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, raw) to (lang, source, term, n, docs), added up as far as HELD allows."""
    groups: dict[tuple, tuple[Counter, Counter]] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (counts, docs) in groups.items():
            words = list(counts)
            yield pa.record_batch(
                [pa.array([lang] * len(words), pa.string()),
                 pa.array([source] * len(words), pa.string()),
                 pa.array(words, pa.binary()).cast(pa.string()),
                 pa.array(counts.values(), pa.int64()),
                 pa.array(map(docs.__getitem__, words), pa.int64())],
                names=["lang", "source", "term", "n", "docs"])
        groups.clear()

    held = 0
    for batch in T.rows(batches, 64):
        for lang, source, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            own = Counter(terms(raw))
            if not own:
                continue
            if (lang, source) not in groups:
                groups[lang, source] = Counter(), Counter()
            counts, docs = groups[lang, source]
            held -= len(counts)
            counts.update(own)
            docs.update(own.keys())
            held += len(counts)
            if held >= HELD:
                yield from flush()
                held = 0
    yield from flush()


def kept_terms(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, lang_n and, on one row of each (lang, term), first = 1 (else 0).

    Terms that occur in at least DOCUMENTS documents of the language. All rows of a (lang, term)
    meet in one shuffle; they are one for each source, and a few more of tasks that handed on early.
    """
    spread = (docs.select(F.coalesce("lang", F.lit("")).alias("lang"),
                          F.coalesce("source", F.lit("")).alias("source"),
                          F.coalesce("text", F.lit("")).cast("binary").alias("raw"))
              .mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
              .repartition("lang", "term"))
    counts = (spread.groupBy("lang", "term", "source")
              .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    own = Window.partitionBy("lang", "term")
    return (counts
            .withColumns({"lang_n": F.sum("n").over(own), "lang_docs": F.sum("docs").over(own),
                          "first": F.row_number().over(own.orderBy("source"))})
            .where(F.col("lang_docs") >= DOCUMENTS)
            .select("lang", "source", "term", "n", "lang_n",
                    (F.col("first") == 1).cast("int").alias("first")))


def group_totals(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, total, lang_total, vocabulary of every group that occurs."""
    groups = docs.select(F.coalesce("lang", F.lit("")).alias("lang"),
                         F.coalesce("source", F.lit("")).alias("source")).distinct()
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.sum("first").alias("v"))
    both = groups.join(sums, ["lang", "source"], "left").fillna(0, ["total", "v"])
    langs = both.groupBy("lang").agg(F.sum("total").alias("lang_total"),
                                     F.sum("v").alias("vocabulary"))
    return both.drop("v").join(langs, "lang")


def rate(count: str, total: str) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * vocabulary)), exact for all 64-bit counts."""
    return F.expr(f"1 + CAST({SCALE} AS DECIMAL(10,0)) * CAST({count} + 2 AS DECIMAL(20,0))"
                  f" DIV CAST({total} + 2 * vocabulary AS DECIMAL(20,0))")


def divergence(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) DIV ({p} + {q})")


class Skyband:
    """Takes (count in the language, term) in an order in which dominators come first."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.terms: list[str] = []  # the kept ones, by UTF-8: Python's order of str
        self.counts = np.empty(64, np.int64)  # in the same order

    def keeps(self, count: int, term: str) -> bool:
        """Whether fewer than k of those before dominate this one.

        It is enough to count the kept ones: a term that was left out has k dominators among them,
        and they dominate all that it dominates.
        """
        size, at = len(self.terms), bisect_left(self.terms, term)
        if at >= self.k and np.count_nonzero(self.counts[:at] <= count) >= self.k:
            return False
        if size == len(self.counts):
            self.counts = np.concatenate([self.counts, np.empty(size, np.int64)])
        self.counts[at + 1:size + 1] = self.counts[at:size]
        self.counts[at] = count
        self.terms.insert(at, term)
        return True


def _thinned(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Keeps the skyband of each run of equal first columns (all but term, n and lang_n)."""

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, band = None, None
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            keep = []
            for i, (*own, term, _, lang_n) in enumerate(zip(*columns, strict=True)):
                if own != key:
                    key, band = own, Skyband(k)
                if band.keeps(lang_n, term):
                    keep.append(i)
            yield batch.take(pa.array(keep, pa.int64()))

    return thin


def skyband(kept: DataFrame, k: int = TOP, parts: int = PARTS) -> DataFrame:
    """lang, source, term, n, lang_n: the terms of each group that fewer than k others dominate."""
    order = (F.desc("n"), "lang_n", "term")
    columns = ("term", "n", "lang_n")
    dealt = kept.select("lang", "source", F.pmod(F.xxhash64("term"), F.lit(parts)).alias("number"),
                        *columns)
    for keys in (("lang", "source", "number"), ("lang", "source")):
        rows = (dealt.select(*keys, *columns).repartition(*keys)
                .sortWithinPartitions(*keys, *order))
        dealt = rows.mapInArrow(_thinned(k), rows.schema)
    return dealt


def top_terms(kept: DataFrame, totals: DataFrame, k: int = TOP) -> DataFrame:
    """The k terms of each group with the greatest divergence among those it uses more often."""
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rates = (skyband(kept, k).join(totals, ["lang", "source"])
             .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                     rate("n", "total").alias("p"), rate("lang_n", "lang_total").alias("q")))
    return (rates.where("p > q").withColumn("value", divergence("p", "q"))
            .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("lang", "source", "part", "item", "value", "rank"))


def _rates(counts: np.ndarray, total: int, vocabulary: int) -> np.ndarray:
    below = total + 2 * vocabulary
    if int(counts.max(initial=0)) + 2 < (1 << 63) // SCALE:
        return 1 + SCALE * (counts + 2) // below
    return np.array([1 + SCALE * (int(c) + 2) // below for c in counts.tolist()], np.int64)


class _Block:
    """Sums for the pairs of two blocks of sources over the terms of one part."""

    def __init__(self, alone: bool) -> None:
        self.alone = alone  # a block with itself
        self.at: dict[str, int] = {}
        self.sides: list[list[int]] = [[], []]
        self.totals: list[tuple[int, int]] = []
        self.pending: list[tuple[int, int, int]] = []
        self.names: dict[str, int] = {}
        self.sums: list[tuple[int, np.ndarray, np.ndarray]] = []

    def head(self, side: int, source: str, total: int, vocabulary: int) -> None:
        """All sources of both blocks come before the first term."""
        self.at[source] = len(self.totals)
        self.sides[side].append(self.at[source])
        self.totals.append((total, vocabulary))

    def add(self, source: str, term: str, n: int) -> None:
        """Terms come one after the other, each with the sources that have it."""
        if term not in self.names:
            if len(self.names) == TERMS:
                self.compare()
            self.names[term] = len(self.names)
        self.pending.append((self.names[term], self.at[source], n))

    def compare(self) -> None:
        if not self.sums:
            left, right = self.sides
            if self.alone:
                order = left
                self.sums = [(a, np.array(order[i + 1:], int), np.zeros(len(order) - i - 1, np.int64))
                             for i, a in enumerate(order)]
            else:
                self.sums = [(a, np.array(right, int), np.zeros(len(right), np.int64))
                             for a in left]
        counts = np.zeros((len(self.names), len(self.totals)), np.int64)
        rows, columns, values = zip(*self.pending, strict=True) if self.pending else ((), (), ())
        counts[list(rows), list(columns)] = values
        rates = np.stack([_rates(counts[:, i], *own) for i, own in enumerate(self.totals)], axis=1)
        absent = np.array([_rates(np.zeros(1, np.int64), *own)[0] for own in self.totals])
        for a, others, sums in self.sums:
            p, q = rates[:, a:a + 1], rates[:, others]
            sums += ((p - q) ** 2 // (p + q)).sum(axis=0)
            sums -= len(rates) * ((absent[a] - absent[others]) ** 2 // (absent[a] + absent[others]))
        self.pending, self.names = [], {}

    def rows(self, lang: str) -> Iterator[pa.RecordBatch]:
        if not self.names:
            return
        self.compare()
        sources = list(self.at)
        for a, others, sums in self.sums:
            yield pa.record_batch(
                [pa.array([lang] * len(others), pa.string()),
                 pa.array([sources[a]] * len(others), pa.string()),
                 pa.array([sources[i] for i in others], pa.string()), pa.array(sums, pa.int64())],
                names=["lang", "a", "b", "excess"])


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, block = None, None
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for lang, x, y, number, term, source, side, n, total, vocabulary in zip(*columns,
                                                                                strict=True):
            if (lang, x, y, number) != key:
                if block:
                    yield from block.rows(key[0])
                key, block = (lang, x, y, number), _Block(x == y)
            if term is None:
                block.head(side, source, total, vocabulary)
            else:
                block.add(source, term, n)
    if block:
        yield from block.rows(key[0])


def pair_sums(kept: DataFrame, totals: DataFrame, blocks: int, parts: int) -> DataFrame:
    """lang, a, b (each pair in one order), excess: the sum of divergences over all kept terms less
    that of as many terms which neither source has. Pairs with no excess may be missing."""
    own = F.pmod(F.xxhash64("source"), F.lit(blocks))
    # Block x meets block y >= x; a source of block z is in the pairs (x, z) and (z, y).
    pairs = F.explode(F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda i: F.struct(
        F.least(i.cast("long"), F.col("z")).alias("x"),
        F.greatest(i.cast("long"), F.col("z")).alias("y"))))
    side = F.when(F.col("z") == F.col("pair.x"), 0).otherwise(1)
    nothing = F.lit(None)
    data = (kept.withColumn("z", own).withColumn("pair", pairs)
            .select("lang", "pair.x", "pair.y",
                    F.pmod(F.xxhash64("term"), F.lit(parts)).alias("number"), "term", "source",
                    side.alias("side"), "n", nothing.cast("long").alias("total"),
                    nothing.cast("long").alias("vocabulary")))
    heads = (totals.withColumn("z", own).withColumn("pair", pairs)
             .withColumn("number", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
             .select("lang", "pair.x", "pair.y", F.col("number").cast("long").alias("number"),
                     nothing.cast("string").alias("term"), "source", side.alias("side"),
                     nothing.cast("long").alias("n"), "total", "vocabulary"))
    keys = ("lang", "x", "y", "number")
    return (data.unionByName(heads).repartition(*keys)
            .sortWithinPartitions(*keys, F.asc_nulls_first("term"), "source")
            .mapInArrow(_compared, "lang string, a string, b string, excess long")
            .groupBy("lang", "a", "b").agg(F.sum("excess").alias("excess")))


def pair_divergence(kept: DataFrame, totals: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every source against each other one of its language: their divergence over all kept terms."""
    spark = kept.sparkSession
    most = (totals.groupBy("lang").count().agg(F.max("count")).first()[0]) or 1
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    sums = pair_sums(kept, totals, -(-most // block), parts)
    both = sums.unionByName(sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"),
                                        "excess"))
    absent = totals.select("lang", "source", "vocabulary", F.when(
        F.col("vocabulary") > 0, rate("0", "total")).alias("p"))
    other = absent.select("lang", F.col("source").alias("item"), F.col("p").alias("q"))
    pairs = (absent.join(other, "lang").where("source <> item")
             .join(both.select("lang", F.col("a").alias("source"), F.col("b").alias("item"),
                               "excess"), ["lang", "source", "item"], "left"))
    value = F.coalesce(F.col("vocabulary") * divergence("p", "q"), F.lit(0))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (pairs.withColumn("value", value + F.coalesce("excess", F.lit(0)))
            .withColumn("rank", F.row_number().over(best))
            .select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank"))


def audit(docs: DataFrame) -> DataFrame:
    """lang, source, part, item, value, rank: parts ``pair`` and ``term`` of every group.

    A group is a (lang, source) that occurs; nulls in ``text``, ``lang`` and ``source`` are empty
    strings. A language keeps the terms that stand in DOCUMENTS of its documents at least, every row
    being a document, repeated ones too. ``pair`` has each other source of the language with the
    divergence summed over all kept terms (0 if there are none); ``term`` the TOP terms that the
    group uses more often than the language. Equal values are ranked by the UTF-8 of the item. Whole
    texts count, of any length; an empty table gives no rows; other columns are ignored. ``pair`` has
    as many rows as the language has pairs of sources, which is what it is asked for.
    """
    kept = T.written(kept_terms(docs), "kept-terms")
    totals = T.written(group_totals(docs, kept), "group-totals")
    found = pair_divergence(kept, totals).unionByName(top_terms(kept, totals))
    return found.withColumns({"value": F.col("value").cast("long"),
                              "rank": F.col("rank").cast("int")})
