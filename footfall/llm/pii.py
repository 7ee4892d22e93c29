"""Personal data: patterns, and terms that give a protected entity away.

Emails, IP addresses, card and phone numbers are found by pattern. Each distinct value is a
protected entity e with information content IC(e) = -log2 p(e). For the words t, numbers too, of
the documents that hold an entity, the corpus tells how far t discloses e: PMI(e; t) / IC(e), which
is 1 where every document with t has e in it, and 0 where t says nothing about e. A term that passes
the threshold for some entity is generalised to the entity's kind, or removed if it all but names
the entity, wherever it occurs. Evidence is SUPPORT different surroundings of the entity, with t
among them or elsewhere in documents that differ there.

Words are looked up in a filter of fixed size (no false negatives) while texts are read; what it
lets through is joined with the exact table, whose size is not bounded.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm import text as T

KINDS = ("email", "ip", "card", "phone")
WINDOW = 6  # words on either side of an entity
SUPPORT = 3  # different surroundings of an entity that a term must go with
DISCLOSED = 0.9  # share of the entity's information that a term may give away
REMOVED = 0.99  # from here on the term goes altogether
FILTER_BITS = 1 << 23
HELD = 200_000  # counters of a task before it hands them on
SCHEMA = ("doc_id long, text string, n_email long, n_ip long, n_card long, n_phone long, "
          "base string, spans string")

# The same matches as the plain patterns, but no run of characters is tried twice.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"\w+")
Span = tuple[str, int, int]


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        first = at
        while first > done and text[first - 1] in _LOCAL:
            first -= 1
        domain = _DOMAIN.match(text, at + 1) if first < at else None
        done = domain.end() if domain else at + 1
        if domain:
            yield first, done
        at = text.find("@", done)


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        double = digit * 2 if place % 2 else digit
        total += double - 9 if double > 9 else double
    return total % 10 == 0


def _ips(text: str) -> Iterator[tuple[int, int]]:
    # Two addresses may share no digit: after a match the search goes on behind it.
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p) < 256 for p in m.group().split(".")):
            yield m.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
            yield m.span()


_FINDERS = (_emails, _ips, _cards, _phones)


def base_spans(text: str) -> list[Span]:
    """The pattern matches by start, then kind; code points, end exclusive."""
    found = [(start, k, end) for k, finder in enumerate(_FINDERS) for start, end in finder(text)]
    return [(KINDS[k], start, end) for start, k, end in sorted(found)]


def _entity(kind: str, value: str) -> str:
    """One spelling for each entity."""
    return f"{kind}:{value.lower() if kind == 'email' else re.sub('[^0-9.]', '', value)}"


def _long(value: str) -> int:
    return T.xxhash.xxh3_64_intdigest(value.encode()) - (1 << 63)


def _term(word: str) -> int:
    """The hash of a word, a number or a letter; which ones are terms is left to the counts."""
    return _long(word.lower())


def _keyed(docs: DataFrame) -> DataFrame:
    return T.texts(docs).withColumn("key", F.xxhash64("text"))


def _surroundings(text: str) -> dict[int, tuple[int, list[tuple[int, int]], dict[int, set[int]]]]:
    """For each entity of a text: its kind, its places, and the terms of each surrounding."""
    out: dict = {}
    for kind, start, end in base_spans(text):
        # The nearest words; a run of letters without end is no word near by.
        before = _WORD.findall(text[max(0, start - 40 * WINDOW):start])[-WINDOW:]
        after = _WORD.findall(text[end:end + 40 * WINDOW])[:WINDOW]
        around = _long(" ".join([*before, "\n", *after]))
        entity = _long(_entity(kind, text[start:end]))
        _, places, near = out.setdefault(entity, (KINDS.index(kind), [], {}))
        places.append((start, end))
        near.setdefault(around, set()).update(map(_term, {*before, *after}))
    return out


def _entities(docs: DataFrame) -> DataFrame:
    """key, entity, around, first: the surroundings of the entities of each text.

    ``key`` is the hash of the text; one surrounding of an entity in a text is its ``first``.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.rows(batches):
            out = [(key, entity, around, int(around == min(near)))
                   for text, key in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(),
                                        strict=True)
                   for entity, (_, _, near) in _surroundings(text).items() for around in near]
            columns = list(zip(*out, strict=True)) or [()] * 4
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns],
                                  names=["key", "entity", "around", "first"])

    return _keyed(docs).mapInArrow(found, "key long, entity long, around long, first long")


def _company(docs: DataFrame, keys: np.ndarray, asked: np.ndarray) -> DataFrame:
    """entity, kind, term, around, near, whole: the terms that go with the entities asked for.

    ``near``: the term stands in this surrounding of the entity; ``whole``, once for each text
    with both: it stands anywhere in the text, with the entity's first surrounding. ``keys`` and
    ``asked`` are filters of texts and entities.
    """
    names = ["entity", "kind", "term", "around", "near", "whole"]

    def made(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [()] * 6
        return pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=names)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.rows(batches):
            batch = batch.filter(pa.array(_passes(keys, batch.column(2).to_numpy())))
            out: list[tuple] = []
            for text in batch.column(1).to_pylist():
                words = None
                for entity, (kind, places, near) in _surroundings(text).items():
                    if not _passes(asked, np.array([entity]))[0]:
                        continue
                    words = words or [(m.start(), m.end(), _term(m.group()))
                                      for m in _WORD.finditer(text)]
                    starts, ends = zip(*places, strict=True)
                    # A word of the entity itself is no term; matches of one kind share nothing.
                    terms = {t for s, e, t in words
                             if not (k := bisect_left(starts, e)) or ends[k - 1] <= s}
                    terms.update(*near.values())
                    out += [(entity, kind, t, min(near), 0, 1) for t in terms]
                    out += [(entity, kind, t, around, 1, 0) for around in near
                            for t in near[around]]
                    if len(out) > 100_000:
                        yield made(out)
                        out = []
            yield made(out)

    return _keyed(docs).mapInArrow(found, ", ".join(f"{n} long" for n in names))


def _passes(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = values % FILTER_BITS
    return ((bits[at // 64] >> (at % 64)) & 1).astype(bool)


def _filter(terms: DataFrame) -> np.ndarray | None:
    """A bit for each term's hash, FILTER_BITS in all; None if there is no term."""
    at = F.pmod("term", F.lit(FILTER_BITS))
    words = (terms.select((at / 64).cast("int").alias("word"), (at % 64).cast("int").alias("bit"))
             .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)"))
                                  .alias("bits")).collect())
    if not words:
        return None
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    bits[[w.word for w in words]] = [w.bits for w in words]
    return bits


class _Maybe(dict):
    """The hash of each word that the filter lets through; None for all others."""

    def __init__(self, bits: np.ndarray | None, most: int = T.KEPT_WORDS) -> None:
        super().__init__()
        self.bits, self.most = bits, most

    def __missing__(self, word: str) -> int | None:
        if len(self) >= self.most:
            self.clear()
        term = _term(word) if self.bits is not None else None
        if term is not None:
            at = term % FILTER_BITS
            if not (int(self.bits[at // 64]) >> (at % 64)) & 1:
                term = None
        self[word] = term
        return term


def _documents(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    """term, documents: in how many texts each term stands that the filter lets through."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maybe, n = _Maybe(bits), Counter()

        def counted() -> pa.RecordBatch:
            n.pop(None, None)
            return pa.record_batch([pa.array(n.keys(), pa.int64()),
                                    pa.array(n.values(), pa.int64())], names=["term", "n"])

        for batch in T.rows(batches):
            for text in batch.column(1).to_pylist():
                n.update({maybe[w] for w in set(_WORD.findall(text))})
            if len(n) >= HELD:
                yield counted()
                n.clear()
        yield counted()

    return (T.texts(docs).mapInArrow(found, "term long, n long")
            .groupBy("term").agg(F.sum("n").alias("documents")))


def disclosing_terms(docs: DataFrame, support: int = SUPPORT,
                     disclosed: float = DISCLOSED) -> DataFrame:
    """term (hash), kind, disclosure of the terms that give some entity away.

    Counts cover all documents; ``support`` counts different surroundings of the entity, so that
    copies of one passage are no evidence: those that the term stands in, or one for each document
    that holds the term anywhere. A term with several entities has the one it discloses most.
    """
    found = T.written(_entities(docs), "pii-found")
    entities = T.written(
        found.groupBy("entity", "around").agg(F.sum("first").alias("documents"))
        .groupBy("entity").agg(F.sum("documents").alias("documents"), F.count("*").alias("places"))
        .where(F.col("places") >= support).select("entity", "documents"), "pii-entities")
    none = docs.sparkSession.createDataFrame([], "term long, kind int, disclosure double")
    asked = _filter(entities.select(F.col("entity").alias("term")))
    if asked is None:
        return none
    keys = _filter(found.join(entities, "entity", "left_semi").select(F.col("key").alias("term")))
    near = T.written(
        _company(docs, keys, asked).groupBy("entity", "kind", "term", "around")
        .agg(F.sum("whole").alias("together"), F.max("near").alias("near"),
             F.max("whole").alias("whole"))
        .groupBy("entity", F.col("kind").cast("int").alias("kind"), "term")
        .agg(F.sum("together").alias("together"),
             F.greatest(F.sum("near"), F.sum("whole")).alias("places"))
        .where(F.col("places") >= support), "pii-near")
    bits = _filter(near)
    if bits is None:
        return none
    total = max(2, docs.count())
    known = (near.join(entities, "entity")
             .join(_documents(docs, bits).withColumnRenamed("documents", "with_term"), "term"))
    # together <= documents <= total, so the content is positive unless e is everywhere.
    content = -F.log2(F.col("documents") / (total + 1))
    pmi = F.log2(F.least(F.col("together"), F.col("with_term")) * F.lit(total + 1)
                 / (F.col("documents") * F.col("with_term")))
    known = known.withColumn("disclosure", F.least(F.lit(1.0), pmi / content))
    best = F.max(F.struct("disclosure", (-F.col("kind")).alias("order")))
    return (known.where(F.col("disclosure") >= disclosed).groupBy("term").agg(best.alias("b"))
            .select("term", (-F.col("b.order")).alias("kind"), "b.disclosure"))


def _result(text: str, base: list[Span], terms: list[tuple]) -> tuple:
    """The sanitised text, the counts and both lists of spans. terms: (start, end, kind, rate)."""
    listed = [*((start, KINDS.index(kind), end, kind) for kind, start, end in base),
              *((start, len(KINDS), end, "term") for start, end, _, _ in terms)]
    fills = {("term", s, e): "" if rate >= REMOVED else f"[{KINDS[k].upper()}-RELATED]"
             for s, e, k, rate in terms}
    parts, done = [], 0
    for start, _, end, kind in sorted(listed):
        if start < done:  # inside a span that is already masked: mask on to its end
            done = max(done, end)
            continue
        parts += [text[done:start], fills.get((kind, start, end), f"[{kind.upper()}]")]
        done = end
    parts.append(text[done:])
    counts = [sum(kind == k for kind, _, _ in base) for k in KINDS]
    return ("".join(parts), *counts, ",".join(f"{k}:{s}:{e}" for k, s, e in base),
            ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(listed)))


def _final(rows: list[tuple], more: dict[str, pa.Array]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), *[pa.int64()] * 4, pa.string(), pa.string()]
    columns = list(zip(*rows, strict=True)) or [()] * 8
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    return pa.record_batch(
        [*(pa.array(c, k) for c, k in zip(columns, kinds, strict=True)), *more.values()],
        names=[*names, *more])


_MAYBE = "array<struct<term:long,start:long,end:long>>"
_MAYBE_TYPE = pa.list_(pa.struct([("term", pa.int64()), ("start", pa.int64()),
                                  ("end", pa.int64())]))


def _scanned(docs: DataFrame, bits: np.ndarray | None, carry: tuple[str, ...]) -> DataFrame:
    """The result of each text without terms, and the places of words that may be terms."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maybe = _Maybe(bits)
        for batch in T.rows(batches):
            out, texts, places = [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                    strict=True):
                base, own = base_spans(text), []
                out.append((doc_id, *_result(text, base, [])))
                if bits is not None and any(maybe[w] is not None
                                            for w in set(_WORD.findall(text))):
                    inside = np.zeros(len(text) + 1, bool)
                    for _, start, end in base:
                        inside[start:end] = True
                    own = [{"term": term, "start": m.start(), "end": m.end()}
                           for m in _WORD.finditer(text)
                           if (term := maybe[m.group()]) is not None
                           and not inside[m.start():m.end()].any()]
                texts.append(text if own else "")
                places.append(own)
            yield _final(out, {**{c: batch.column(i + 2) for i, c in enumerate(carry)},
                               "original": pa.array(texts, pa.string()),
                               "maybe": pa.array(places, _MAYBE_TYPE)})

    return T.texts(docs, *carry).mapInArrow(
        scan, f"{_schema(docs, carry)}, original string, maybe {_MAYBE}")


def _schema(docs: DataFrame, carry: tuple[str, ...]) -> str:
    kinds = dict(docs.dtypes)
    return ", ".join([SCHEMA, *(f"`{c}` {kinds[c]}" for c in carry)])


def sanitise(docs: DataFrame, support: int = SUPPORT, disclosed: float = DISCLOSED,
             carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the sanitised text, counts by kind, and the spans of each text.

    ``base``: kind:start:end of the pattern matches by start, then kind, joined by commas;
    ``spans``: those and the disclosing terms (kind ``term``). In the text a match gives way to
    its kind in brackets, a term to the kind of its entity or to nothing.

    A null text counts as empty: no spans. A null doc_id is kept; repeated rows are treated
    alike; extra columns are left out unless ``carry`` names them; an empty table gives no rows.
    """
    terms = T.written(disclosing_terms(docs, support, disclosed), "pii-terms")
    # Written, so that the texts are scanned once for the three uses below.
    scanned = T.written(_scanned(docs, _filter(terms), carry), "pii-scanned", "zstd")
    names = [*(f.split()[0] for f in SCHEMA.split(", ")), *carry]
    plain = scanned.where(F.size("maybe") == 0).select(*names)
    # The few texts with words that may be terms: one row for each place, joined exactly.
    key = F.xxhash64("doc_id", "original").alias("key")
    held = scanned.where(F.size("maybe") > 0).withColumn("key", key)
    places = (held.select("key", F.explode("maybe").alias("m")).distinct()
              .join(terms.withColumnRenamed("term", "hash"), F.col("m.term") == F.col("hash"))
              .groupBy("key").agg(F.collect_list(F.struct(
                  F.col("m.start").alias("start"), F.col("m.end").alias("end"), "kind",
                  "disclosure")).alias("terms")))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.rows(batches):
            out = []
            for doc_id, text, own in zip(*(batch.column(i).to_pylist() for i in range(3)),
                                         strict=True):
                found = [(t["start"], t["end"], t["kind"], t["disclosure"]) for t in own or ()]
                out.append((doc_id, *_result(text, base_spans(text), found)))
            yield _final(out, {c: batch.column(i + 3) for i, c in enumerate(carry)})

    joined = held.select("key", "doc_id", "original", *carry).join(places, "key", "left")
    return plain.unionByName(joined.select("doc_id", "original", "terms", *carry)
                             .mapInArrow(finish, _schema(docs, carry)))
