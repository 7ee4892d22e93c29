"""SpotSigs document fingerprints: chains of content words that follow common-word anchors.

Wherever an anchor (a common word) occurs, it and the next ``CHAIN`` content words (words that
are no anchors) make one signature. A document's fingerprint is the set of its signatures, so it
follows the running text and hardly sees lists, menus and other parts without common words.
Two fingerprints are compared by Jaccard similarity, pruned by set length. To find near copies
among all documents, the sets are partitioned by length such that similar ones lie in the same or
neighbouring partitions, and only sets of one partition that share a signature are compared.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm import ngram_join
from footfall.llm import text as T

# Common words of English, German, French and Spanish.
ANCHORS = frozenset(
    "a an and are as at be by for from in is it of on or that the this to was were with "
    "auf aus das dem den der des die ein eine einer für ist mit nicht sich und von zu "
    "au aux avec dans de des du elle en est et la le les ou par pas pour que qui sur un une "
    "al con del el es esta la las lo los no para por se su una y".split())
CHAIN = 2
_WORD = re.compile(r"\w+")


class Signatures:
    """The signature sets of texts."""

    def __init__(self) -> None:
        self.hashes = T.WordHashes()
        self.anchors = np.array(sorted(self.hashes[a] for a in ANCHORS), np.uint64)

    def of(self, text: str) -> np.ndarray:
        """Sorted 32-bit signatures. Without any whole chain each word is a signature."""
        words = self.hashes.of(_WORD.findall(text.lower()))
        if not len(words):
            return np.empty(0, np.uint32)
        place = np.minimum(np.searchsorted(self.anchors, words), len(self.anchors) - 1)
        anchor = self.anchors[place] == words
        content = words[~anchor]
        at = np.flatnonzero(anchor)
        first = np.cumsum(~anchor)[at]  # content words before the anchor: the next one's place
        whole = first + CHAIN <= len(content)
        at, first = at[whole], first[whole]
        if len(at):
            chains = T.chain_hashes([words[at], *(content[first + k] for k in range(CHAIN))])
        else:
            chains = T.mix(words)
        return np.unique((chains >> np.uint64(32)).astype(np.uint32))


def fingerprint(signatures: np.ndarray) -> str:
    """The signatures as text: eight hex digits each, ascending."""
    return signatures.astype(">u4").tobytes().hex()


def jaccard(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard similarity of two sorted sets, or 0 where it is below ``least``.

    The shorter set's length over the longer's bounds the similarity, so pairs whose lengths are
    too far apart are not compared. Two empty sets are alike (1).
    """
    short, long = sorted((len(a), len(b)))
    if long == 0:
        return 1.0
    if short == 0 or short < least * long:
        return 0.0
    shared = len(np.intersect1d(a, b, assume_unique=True))
    found = shared / (short + long - shared)
    return found if found >= least else 0.0


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_signatures, fingerprint of every text (null: empty, with an empty fingerprint)."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signatures = Signatures()
        for batch in T.rows(batches):
            sets = [signatures.of(t) for t in batch.column(1).to_pylist()]
            yield pa.record_batch(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([fingerprint(s) for s in sets], pa.string())],
                names=["doc_id", "n_signatures", "fingerprint"])

    return T.texts(docs).mapInArrow(made, "doc_id long, n_signatures long, fingerprint string")


def followed(docs: DataFrame) -> DataFrame:
    """Texts dealt into partitions by ranges of doc_id, each range closed by the next one's first.

    Columns: part, closing, key, doc_id, text. Partitions are sorted by part, closing, key and
    text; rows with ``closing`` are the copies that follow a range's last row (after the last
    range: the first row of all). The texts are shuffled once.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = T.texts(docs).withColumn("key", F.coalesce("doc_id", F.lit(-(2**63))))
    shares = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    cuts = []
    if parts > 1:
        cuts = keyed.agg(F.percentile_approx("key", shares, 10 * parts)).first()[0] or []
    cuts = F.lit(sorted(set(cuts))) if cuts else F.array().cast("array<long>")
    keyed = keyed.withColumn("part", F.size(F.filter(cuts, lambda c: c < F.col("key"))))
    # At most one row for each partition: the first key of each range that has rows.
    firsts = sorted((r[0], r[1]) for r in keyed.groupBy("part").agg(F.min("key")).collect())
    before = {key: firsts[i - 1][0] for i, (_, key) in enumerate(firsts)}
    closing = F.lit(None).cast("int")
    if before:
        closing = F.try_element_at(F.create_map(*[F.lit(x) for kv in before.items() for x in kv]),
                                   F.col("key"))
    # A row goes to its own range and, if it is a first one, to the range before as well.
    dealt = keyed.select(
        F.explode(F.array_compact(F.array(
            F.struct("part", F.lit(False).alias("closing")),
            F.when(closing.isNotNull(), F.struct(closing.alias("part"),
                                                 F.lit(True).alias("closing")))))).alias("to"),
        "key", "doc_id", "text")
    return (dealt.select("to.part", "to.closing", "key", "doc_id", "text")
            .repartitionById(max(1, parts), F.col("part"))
            .sortWithinPartitions("part", "closing", "key", "text"))


EDITED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Each text's fingerprint beside that of its edited text and its likeness to the next one's.

    Edited: the last floor(n/4) code points give way to the first as many (or all) of the next
    document by ascending doc_id; after the last comes the first; a null id comes before all
    others; equal ids are ordered by text. A single document follows itself.
    """

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signatures = Signatures()
        out: list[tuple] = []
        held = None  # part, doc_id, text, signatures of the row that waits for its next one
        closed = None

        def row(doc_id: int, text: str, own: np.ndarray, after: str, next_one: np.ndarray) -> None:
            cut = len(text) // 4
            edited = text[:len(text) - cut] + after[:cut]
            other = signatures.of(edited)
            out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(),
                        fingerprint(own), fingerprint(other), jaccard(own, other),
                        jaccard(own, next_one)))

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * 7
            kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
            names = [f.split()[0] for f in EDITED.split(", ")]
            out.clear()
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                   names=names)

        for batch in T.rows(batches, 256):
            for part, closing, doc_id, text in zip(*(batch.column(i).to_pylist()
                                                     for i in (0, 1, 3, 4)), strict=True):
                if closing and part == closed:
                    continue  # equal first ids: the first of them closes the range
                own = signatures.of(text)
                if held is not None:
                    row(held[1], held[2], held[3], text, own)
                held = None if closing else (part, doc_id, text, own)
                closed = part if closing else closed
            yield flushed()

    return followed(docs).mapInArrow(made, EDITED)


class _Lengths(ngram_join.Scheme):
    """Partitions by set length; within one, similar sets share one of their first signatures."""

    def __init__(self, percent: int) -> None:
        super().__init__(CHAIN, percent)

    def shingles(self, text: str, hashes: T.WordHashes) -> np.ndarray:
        made = self.__dict__.setdefault("made", Signatures())
        return made.of(text).astype(np.uint64)

    def signatures(self, shingles: np.ndarray) -> np.ndarray:
        """The first n - ceil(share * n) + 1 signatures, for its own and the next partition.

        Similar sets have at least the share of either in common, so these first ones meet. The
        order is that of the hashes with their digits mixed, the same for all sets.
        """
        n = len(shingles)
        if not n:
            return shingles
        first = np.sort(T.mix(shingles))[:n + 1 + (-self.percent * n // 100)]
        own = int(np.log(n) / np.log(100 / self.percent) + 1e-9) if self.percent < 100 else n
        return np.concatenate([T.mix(first ^ np.uint64(length << 40)) for length in (own, own + 1)])


def near_copies(docs: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles (signatures), component_id: the smallest doc_id reachable by links.

    Documents link if the Jaccard similarity of their fingerprints is at least ``percent`` %.
    A null, empty or wordless text is alone. Ids should be unique; rows that repeat one with the
    same text are returned once each; extra columns are ignored.
    """
    return ngram_join.classes(docs, _Lengths(percent))
