"""Jaccard join of word n-gram sets by PartEnum signatures, as connected components.

Two sets of sizes a and b have a Jaccard similarity of p % or more only if they differ in at most
(100 - p)(a + b)/(100 + p) shingles. For each band of sizes, whose largest size bounds that
difference by k, the domain of shingle hashes is cut into groups and each group into parts. Some
group then holds at most one of the differing shingles, so the sets agree in all its parts but
one: for every group and every part left out, the shingles of the other parts make one signature,
and similar sets share at least one. A set also signs for the next band if a partner may be there.

A signature of no shingles would bring together sets that have nothing in common. There are some
groups more than needed, so that a set with few such signatures can leave them out; one with too
many signs again by other groups, and only what fails in every round keeps them.

Sets that share a signature form a bucket. Buckets with the same members count once. Within a
bucket not all pairs are formed: first every set meets the set that most others share a bucket
with; what is linked is joined into components; and only members of different components of a
bucket meet, if a sketch of both sets (parities of shingle counts, which can only understate the
difference) does not exclude them. Every link is verified with the whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm import text as T
from footfall.llm.components import components as connected

FILTER_BITS = 1 << 24
PARTS = 16  # that the documents of one class are dealt into
BLOCK = 256  # members of a bucket that meet in one group
SPLIT = 2  # parts of a group
ROUNDS = 3  # of groups that a set may sign by
_LOWEST = 9  # largest size of the lowest band; three bands double it


class Scheme:
    """Bands, groups and parts for word n-grams that are alike by ``percent`` or more."""

    def __init__(self, words: int, percent: int) -> None:
        self.words, self.percent = words, percent

    @staticmethod
    @lru_cache(maxsize=None)
    def _top(band: int) -> int:
        return int(_LOWEST * 2 ** (band / 3))

    def band(self, size: int) -> int:
        band = max(0, int(3 * np.log2(max(1, size) / _LOWEST)) - 1)
        while self._top(band) < size:
            band += 1
        while band and self._top(band - 1) >= size:
            band -= 1
        return band

    def differing(self, a, b):
        """The most shingles in which similar sets of these sizes differ."""
        return (100 - self.percent) * (a + b) // (100 + self.percent)

    def shingles(self, text: str, hashes: T.WordHashes) -> np.ndarray:
        """Sorted hashes of the distinct n-grams; a shorter text is one n-gram."""
        found = T.WORDS.findall(T.lower_ascii(text))
        if not found:
            return np.empty(0, np.uint64)
        if len(found) < self.words:
            return T.mix(np.array([xxhash.xxh3_64_intdigest("\x20".join(found).encode())],
                                  np.uint64))
        words = hashes.of(found)
        n = len(words) - self.words + 1
        return np.unique(T.chain_hashes([words[i:i + n] for i in range(self.words)]))

    def signatures(self, shingles: np.ndarray) -> np.ndarray:
        size = len(shingles)
        if not size:
            return np.empty(0, np.uint64)
        out = []
        for band in range(self.band(size), self.band(100 * size // self.percent) + 1):
            k = self.differing(self._top(band), self._top(band))
            if k == 0:
                continue  # only equal sets, which are one class already
            spare = 1 + self.differing(k, 0)
            groups = (k + 2) // 2 + spare  # so 1 + spare groups hold at most one difference
            for turn in range(ROUNDS):
                keys, empty = self._signed(shingles, band, turn, groups)
                # Agreeing in nothing is no likeness. Of the ``1 + spare`` groups that similar
                # sets agree in, one is not empty if either set has at most ``spare`` such
                # groups. If both have more, both sign in the next round as well.
                few = empty.any(axis=1).sum() <= spare
                last = turn == ROUNDS - 1
                out.append(keys[~empty] if few or not last else keys.ravel())
                if few:
                    break
        return np.unique(np.concatenate(out)) if out else np.empty(0, np.uint64)

    @staticmethod
    def _signed(shingles: np.ndarray, band: int, turn: int,
                groups: int) -> tuple[np.ndarray, np.ndarray]:
        """[group, part left out]: a signature of the other parts, and whether they are empty."""
        if turn:
            shingles = np.sort(T.mix(shingles ^ np.uint64(0x9E3779B9 * turn)))
        sums = np.concatenate([np.zeros(1, np.uint64),
                               np.cumsum(T.mix(shingles ^ np.uint64(0x5BD1E995)))])
        cuts = np.linspace(0, 2.0 ** 64, groups * SPLIT + 1)[1:-1].astype(np.uint64)
        ends = np.concatenate([[0], np.searchsorted(shingles, cuts), [len(shingles)]])
        part = (sums[ends[1:]] - sums[ends[:-1]]).reshape(groups, SPLIT)
        count = np.diff(ends).reshape(groups, SPLIT)
        rest = part.sum(axis=1, keepdims=True) - part
        left = count.sum(axis=1, keepdims=True) - count
        name = (np.uint64((band << 40) + (turn << 36))
                + np.arange(groups * SPLIT, dtype=np.uint64))
        keys = T.chain_hashes([name, rest.ravel(), left.ravel().astype(np.uint64)])
        return keys.reshape(groups, SPLIT), left == 0

    def sketch(self, shingles: np.ndarray) -> bytes:
        """Parities of the shingles in a power of two of cells, about four for each difference."""
        size = len(shingles)
        cells = 256
        while cells < 4 * self.differing(size, size):
            cells *= 2
        at = (T.mix(shingles + np.uint64(77)) & np.uint64(cells - 1)).astype(np.int64)
        odd = np.bincount(at, minlength=cells) & 1
        return np.packbits(odd.astype(np.uint8)).tobytes()

    def linked(self, a: np.ndarray, b: np.ndarray) -> bool:
        shared = len(np.intersect1d(a, b, assume_unique=True))
        return 100 * shared >= self.percent * (len(a) + len(b) - shared)


def folded(sketch: np.ndarray, cells: int) -> np.ndarray:
    """[row, byte] sketches folded to fewer cells; parities of cells that meet are added."""
    while sketch.shape[1] * 8 > cells:
        half = sketch.shape[1] // 2
        sketch = sketch[:, :half] ^ sketch[:, half:]
    return sketch


def _sets(docs: DataFrame, scheme: Scheme) -> DataFrame:
    """doc_id, a 128-bit key of the set, its size, signatures and sketch."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = T.WordHashes()
        for batch in T.rows(batches, 128):
            keys, sizes, signatures, sketches = ([], []), [], [], []
            for text in batch.column(1).to_pylist():
                own = scheme.shingles(text, hashes)
                key = np.frombuffer(xxhash.xxh3_128_digest(own.tobytes()), np.int64)
                keys[0].append(int(key[0]))
                keys[1].append(int(key[1]))
                sizes.append(len(own))
                signatures.append(scheme.signatures(own).view(np.int64))
                sketches.append(scheme.sketch(own))
            yield pa.record_batch(
                [batch.column(0), pa.array(keys[0], pa.int64()), pa.array(keys[1], pa.int64()),
                 pa.array(sizes, pa.int64()), pa.array(signatures, pa.list_(pa.int64())),
                 pa.array(sketches, pa.binary())],
                names=["doc_id", "key", "key2", "n", "signatures", "sketch"])

    return T.texts(docs).mapInArrow(
        made, "doc_id long, key long, key2 long, n long, signatures array<long>, sketch binary")


def _words(values: DataFrame, name: str) -> DataFrame:
    """word, bits: FILTER_BITS bits, set at the hash of each value, as words of 64."""
    at = F.pmod(F.xxhash64(name), F.lit(FILTER_BITS))
    return (values.select((at / 64).cast("int").alias("word"), (at % 64).cast("int").alias("bit"))
            .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")))


def _filter(values: DataFrame, name: str) -> np.ndarray:
    """FILTER_BITS bits, set at the hash of each value: the driver gets these bits alone."""
    words = _words(values, name).toArrow()
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    bits[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return bits


def _passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes % FILTER_BITS
    return ((bits[at // 64] >> (at % 64)) & 1).astype(bool)


def without(rows: DataFrame, name: str, ids: DataFrame) -> DataFrame:
    """The rows whose column ``name`` is not among ``ids`` (one column of that name).

    Rows that a filter of fixed size tells apart from all ids stay where they are; the others
    alone are shuffled and joined.
    """
    at = F.pmod(F.xxhash64(name), F.lit(FILTER_BITS))
    asked = (rows.withColumn("_word", (at / 64).cast("int"))
             .join(F.broadcast(_words(ids, name).toDF("_word", "_bits")), "_word", "left"))
    maybe = F.coalesce(F.getbit("_bits", at % 64), F.lit(0)) == 1
    return (asked.where(~maybe).select(*rows.columns)
            .unionByName(asked.where(maybe).join(ids, name, "left_anti").select(*rows.columns)))


def _buckets(reps: DataFrame) -> DataFrame:
    """signature, id, members of the buckets with several ids, one for each set of members.

    The signatures are shuffled once, with nothing but their id.
    """
    same = Window.partitionBy("signature")
    mark = [F.bit_xor(F.xxhash64("id", F.lit(i))).over(same).alias(f"x{i}") for i in (1, 2)]
    shared = (reps.select(F.explode("signatures").alias("signature"), "id")
              .withColumn("rows", F.count("*").over(same)).where("rows > 1")
              .select("signature", "id").distinct()  # rows of one id would cancel out in a mark
              .select("signature", "id", F.count("*").over(same).alias("members"), *mark)
              .where("members > 1"))
    shared = T.written(shared, "ngram-shared")
    firsts = (shared.groupBy("members", "x1", "x2").agg(F.min("signature").alias("signature"))
              .select("signature"))
    return T.written(shared.join(firsts, "signature", "left_semi")
                     .select("signature", "id", "members"), "ngram-members")


def _possible(pairs: DataFrame, info: DataFrame, scheme: Scheme) -> DataFrame:
    """The pairs (a, b, ...) that sizes and sketches do not exclude."""
    names = pairs.columns

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(batch.schema.get_field_index(n)).to_pylist()
                    for n in ("sketch_a", "sketch_b"))
            sizes = [batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False)
                     for n in ("n_a", "n_b")]
            most = scheme.differing(*sizes)
            able = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(a, b, strict=True)):
                cells = 8 * min(len(x), len(y))
                x, y = (folded(np.frombuffer(s, np.uint8)[None, :], cells) for s in (x, y))
                able[i] = np.bitwise_count(x ^ y).sum() <= most[i]
            yield batch.select(names).filter(pa.array(able))

    sized = [info.select(F.col("id").alias(s), F.col("n").alias(f"n_{s}"),
                         F.col("sketch").alias(f"sketch_{s}")) for s in "ab"]
    both = (pairs.join(sized[0], "a").join(sized[1], "b")
            .where(F.lit(100) * F.least("n_a", "n_b")
                   >= F.lit(scheme.percent) * F.greatest("n_a", "n_b")))
    return both.select(*names, "n_a", "n_b", "sketch_a", "sketch_b").mapInArrow(
        keep, pairs.schema)


def _links(pairs: DataFrame, docs: DataFrame, scheme: Scheme) -> DataFrame:
    """The pairs (a, b) of ids whose whole sets are alike enough."""
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
    ids = T.written(ids.distinct(), "ngram-asked")
    bits = _filter(ids, "id")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = T.WordHashes()
        for batch in T.rows(batches, 256):
            asked = batch.filter(pa.array(_passes(bits, batch.column(2).to_numpy(
                zero_copy_only=False))))
            yield pa.record_batch(
                [asked.column(0), pa.array([scheme.shingles(t, hashes).tobytes()
                                            for t in asked.column(1).to_pylist()], pa.binary())],
                names=["id", "shingles"])

    found = T.texts(docs).where("doc_id IS NOT NULL").withColumn("hash", F.xxhash64("doc_id"))
    found = found.mapInArrow(sets, "id long, shingles binary").join(ids, "id", "left_semi")
    # An id with several texts stands for the class of its first one by key.
    found = T.written(found, "ngram-sets")

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.rows(batches, 512):
            x, y = (batch.column(i).to_pylist() for i in (2, 3))
            keep = [scheme.linked(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64))
                    for a, b in zip(x, y, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    x = found.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    y = found.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(
        alike, "a long, b long")


def _apart(buckets: DataFrame, roots: DataFrame, info: DataFrame, scheme: Scheme) -> DataFrame:
    """Pairs (a, b) of a bucket's members of different components that a sketch allows.

    A bucket is dealt into blocks of about BLOCK members; each two blocks meet in one group.
    """
    rows = (buckets.join(roots.withColumnRenamed("node", "id"), "id", "left")
            .withColumn("root", F.coalesce("root", "id")))
    open_ones = (rows.groupBy("signature").agg(F.min("root").alias("l"), F.max("root").alias("h"))
                 .where("l <> h").select("signature"))
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("id"), blocks).cast("int")
    rows = (rows.join(open_ones, "signature").join(info, "id")
            .select("signature", "id", "root", "n", "sketch", own.alias("own"),
                    F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
            .select("signature", F.least("own", "other").alias("i"),
                    F.greatest("own", "other").alias("j"), "id", "root", "n", "sketch", "own"))

    def meet(group: pa.Table) -> pa.Table:
        ids, root, n, own = (group.column(c).to_numpy() for c in ("id", "root", "n", "own"))
        raw = group.column("sketch").to_pylist()
        cells = 8 * min(map(len, raw))
        sketch = np.concatenate([folded(np.frombuffer(s, np.uint8)[None, :], cells)
                                 for s in raw])
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        a, b = [], []
        for x in left:
            y = right[(root[right] != root[x]) & ((i != j) | (ids[right] < ids[x]))]
            y = y[100 * np.minimum(n[y], n[x]) >= scheme.percent * np.maximum(n[y], n[x])]
            y = y[np.bitwise_count(sketch[y] ^ sketch[x]).sum(axis=1)
                  <= scheme.differing(n[y], n[x])]
            a.append(np.maximum(ids[y], ids[x]))
            b.append(np.minimum(ids[y], ids[x]))
        empty = [np.empty(0, np.int64)]
        return pa.table({"a": np.concatenate(a or empty), "b": np.concatenate(b or empty)})

    return (rows.groupBy("signature", "i", "j").applyInArrow(meet, "a long, b long").distinct())


def links(docs: DataFrame, scheme: Scheme) -> tuple[DataFrame, DataFrame]:
    """Sets of all documents, and components of their classes: (sets, roots).

    ``sets``: doc_id, key, key2, n, signatures, sketch; equal keys are one class, whose id is the
    smallest doc_id. ``roots``: node, root for the classes that are linked with another.
    """
    sets = T.written(_sets(docs, scheme), "ngram-sets-of-all")
    whole = sets.where("n > 0 AND doc_id IS NOT NULL")
    firsts = whole.groupBy("key", "key2").agg(F.min("doc_id").alias("id")).select("id")
    copies = T.written(whole.select(F.col("doc_id").alias("id")).distinct()
                       .join(firsts, "id", "left_anti"), "ngram-copies")
    reps = without(whole.select(F.col("doc_id").alias("id"), "n", "signatures", "sketch"),
                   "id", copies)
    buckets = _buckets(reps)
    info = T.written(reps.select("id", "n", "sketch")
                     .join(buckets.select("id").distinct(), "id", "left_semi"), "ngram-info")
    # The set with the most company stands in the middle of its bucket.
    company = buckets.groupBy("id").agg(F.sum("members").alias("company"))
    middle = (buckets.join(company, "id").groupBy("signature")
              .agg(F.max(F.struct("company", (-F.col("id")).alias("order"))).alias("m")))
    first = (buckets.join(middle, "signature")
             .select(F.col("id").alias("a"), (-F.col("m.order")).alias("b"),
                     F.col("m.company").alias("company"))
             .where("a <> b").distinct())
    first = (_possible(first, info, scheme).groupBy("a")
             .agg(F.max(F.struct("company", (-F.col("b")).alias("order"))).alias("m"))
             .select("a", (-F.col("m.order")).alias("b")))
    near = T.written(_links(T.written(first, "ngram-first"), docs, scheme), "ngram-near")
    roots = connected(near)
    rest = T.written(_apart(buckets, roots, info, scheme), "ngram-rest")
    if rest.isEmpty():
        return sets, roots
    more = T.written(_links(rest, docs, scheme), "ngram-more")
    if more.isEmpty():
        return sets, roots
    # Links of components: what the first links joined counts as one node.
    return sets, connected(near.unionByName(more))


def components(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id: the smallest doc_id reachable by links.

    Two documents link if 100 * common shingles >= percent * shingles of either. Words are split
    at the six ASCII white-space characters, A-Z in lower case. A document with fewer words than
    ``words`` has one shingle; a null, empty or blank text has none and is its own component, and
    so is a row without id (component null). Ids should be unique; rows that repeat one with the
    same text are returned once each. Extra columns are ignored; an empty table gives no rows.
    """
    return classes(docs, Scheme(words, percent))


def classes(docs: DataFrame, scheme: Scheme) -> DataFrame:
    """The components of the sets that a scheme makes of texts."""
    sets, roots = links(docs, scheme)
    whole = sets.select("doc_id", "key", "key2", "n")
    # Only classes with copies or links say more than a document does by itself. They are copied
    # for each part that the documents of a class are dealt into.
    known = (whole.where("n > 0").groupBy("key", "key2")
             .agg(F.min("doc_id").alias("id"), F.count("doc_id").alias("copies"))
             .join(roots.withColumnRenamed("node", "id"), "id", "left")
             .where("copies > 1 OR root IS NOT NULL")
             .select("key", "key2", F.coalesce("root", "id").alias("component_id"),
                     F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part")))
    dealt = whole.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)).cast("int"))
    return (dealt.join(known, ["key", "key2", "part"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(),
                           F.coalesce("component_id", "doc_id"))
                    .otherwise(F.col("doc_id")).alias("component_id")))
