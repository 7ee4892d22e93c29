"""Language identification by compression.

For each language of the training rows a raw-content zstandard dictionary is made from a bounded
sample of its texts. A text is compressed with every dictionary; the smallest result names the
language. The choice is rejected where the runner-up is hardly larger. Only letters count, in
lower case: marks, digits and capitals say little about a language and much about layout.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm import text as T

# Bounds of the training sample: texts and bytes of each language's dictionary.
SAMPLE_TEXTS = 256
DICTIONARY_BYTES = 112 * 1024
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
_OTHERS = re.compile(r"[\W\d_]+")
SCHEMA = "doc_id long, lang_pred string, score double, margin double, rejected boolean"


def letters(text: str) -> str:
    """The text's runs of letters in lower case, with a blank between."""
    return _OTHERS.sub(" ", text).lower()


def dictionaries(docs: DataFrame, training, sample_texts: int = SAMPLE_TEXTS,
                 size: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """Raw content for each language among the rows where the Column ``training`` holds.

    Up to ``sample_texts`` texts of a language are taken by the smallest hash of their id (ties:
    of their text) and share its ``size`` bytes evenly. Rows without language or text are left
    out. The languages with the most training rows come first, and so win ties.
    """
    chosen = Window.partitionBy("lang").orderBy("rank", "doc_id")
    known = docs.where(F.coalesce(training, F.lit(False)) & F.col("lang").isNotNull()
                       & F.col("text").isNotNull() & F.col("text").rlike(r"\p{L}"))
    ids = (known.select("lang", "doc_id", F.xxhash64("doc_id").alias("rank"))
           .withColumn("n", F.row_number().over(chosen)).where(F.col("n") <= sample_texts))
    # At most sample_texts rows for each language.
    picked = [r.doc_id for r in ids.select("doc_id").collect()]
    share = max(1, size // max(1, sample_texts))
    found: dict[str, list[str]] = {}
    if picked:
        rows = (known.where(F.col("doc_id").isin(picked))
                .select("lang", "doc_id", F.substring("text", 1, 4 * share).alias("text"))
                .groupBy("lang", "doc_id").agg(F.min("text").alias("text"))
                .orderBy("lang", F.xxhash64("doc_id"), "doc_id").collect())
        for row in rows:
            found.setdefault(row.lang, []).append(row.text)
    often = (docs.where(F.coalesce(training, F.lit(False)) & F.col("lang").isNotNull())
             .groupBy("lang").count().orderBy(F.desc("count"), "lang").collect())
    contents = {}
    for lang, some in ((r.lang, found[r.lang]) for r in often if r.lang in found):
        parts, left = [], size
        for n, text in enumerate(sorted(some, key=len)):
            part = letters(text).encode()[:left // (len(some) - n)]
            parts.append(part)
            left -= len(part)
        contents[lang] = b" ".join(parts)
    return contents


class _Languages:
    def __init__(self, contents: Mapping[str, bytes], level: int) -> None:
        self.names = list(contents)
        self.compressors = []
        for name in self.names:
            content = zstandard.ZstdCompressionDict(contents[name],
                                                    dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            # Matches of four bytes on: short words and parts of words count.
            how = zstandard.ZstdCompressionParameters.from_level(
                level, dict_size=len(contents[name]), min_match=4)
            self.compressors.append(zstandard.ZstdCompressor(
                dict_data=content, compression_params=how))

    def of(self, text: str | None, margin: float) -> tuple[str, float, float, bool]:
        if text is None or not self.names or not any(
                m.group().isalpha() for m in _LETTER.finditer(text)):
            return UNKNOWN, 0.0, 0.0, True
        raw = letters(text).encode()
        sizes = np.array([len(c.compress(raw)) for c in self.compressors], float)
        best = int(sizes.argmin())  # ties: the first name
        rest = np.delete(sizes, best)
        lead = float((rest.min() - sizes[best]) / rest.min()) if len(rest) else 1.0
        # Bits per byte saved against the others, as a share.
        weights = np.exp2(np.clip((sizes[best] - sizes) * 8 / max(1, min(len(raw), 64)), -60, 0))
        return self.names[best], float(1 / weights.sum()), lead, lead < margin


def identify(docs: DataFrame, contents: Mapping[str, bytes], level: int = 6,
             margin: float = 0.01) -> DataFrame:
    """doc_id, the language of every text, its score, its lead and whether it is rejected.

    ``margin`` (0 to 1): the lead below which a prediction is marked as rejected, a lead being
    how much smaller the best result is than the runner-up. ``contents`` go to every task; they
    hold ``DICTIONARY_BYTES`` a language. A text that is null, empty or without letters is
    ``und`` with score 0, as is every text if no language was learned. Extra columns are ignored;
    repeated rows are scored once each.
    """
    contents = dict(contents)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages = _Languages(contents, level)
        for batch in T.rows(batches):
            found = [languages.of(t, margin) for t in batch.column(1).to_pylist()]
            columns = list(zip(*found, strict=True)) or [()] * 4
            kinds = [pa.string(), pa.float64(), pa.float64(), pa.bool_()]
            yield pa.record_batch(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=[f.split()[0] for f in SCHEMA.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scored, SCHEMA)
