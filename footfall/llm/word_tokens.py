"""BPE encoding and decoding through a table of distinct words.

Each input split is cut into blocks of bounded size. A block's texts become positions in the
block's list of distinct words, the most frequent first, and only the lists are dealt out: by a hash of the word into
buckets, where each distinct word of the corpus meets one task and is encoded once. The ids go
back to the blocks, where they are joined to the positions. Decoding joins each id with its piece;
that table is the vocabulary, whose size the tokenizer file fixes.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from footfall.llm import text as T
from footfall.llm.byte_tokens import byte_letters

BLOCK_CHARS = 16_000_000
# Code points whose classes and lower case are the same for every library used here.
_PLAIN = re.compile("[\t\n\r\x20-\x7e\xa0-įı-ſ]*")
_LETTER, _DIGIT = "A-Za-zªµºÀ-ÖØ-öø-ſ", "0-9²³¹¼½¾"
# The word pattern of the file (fixed value), with its classes written out for plain texts.
_SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_DIGIT}]|[^\s{_LETTER}{_DIGIT}]+")


class WordFile:
    """A tokenizers file whose words are encoded one by one."""

    _made: dict[str, WordFile] = {}

    @classmethod
    def at(cls, path: str) -> WordFile:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        added = [t["content"] for t in spec["added_tokens"]]
        self.added = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None
        pieces = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pieces = [b""] * (max(pieces.values()) + 1)
        for piece, i in pieces.items():
            self.pieces[i] = piece.encode()
        self.letters = byte_letters()

    def words(self, text: str) -> list[str]:
        """The text's words in order; an added token's string is a word of its own."""
        if self.added and "<" in text and len(parts := self.added.split(text)) > 1:
            return [w for i, part in enumerate(parts)
                    for w in ([part] if i % 2 else self._words(part))]
        return self._words(text)

    def _words(self, text: str) -> list[str]:
        if _PLAIN.fullmatch(text):
            return _SPLIT.findall(text.lower())
        normal = self.tokenizer.normalizer.normalize_str(text)
        return [bytes(map(self.letters.__getitem__, word)).decode()
                for word, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]

    def ids(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]


class _Codes(dict):
    """Numbers words in the order they come."""

    def __missing__(self, word: str) -> int:
        code = self[word] = len(self)
        return code


# Rows of three kinds: the bucket of each of a block's words, most frequent word first (data);
# its words in one bucket in that order (data: the words, later sizes and data: their ids); some
# of its texts (doc_ids, sizes, data: places of their words in the order).
_ORDER, _WORDS, _POSITIONS = 0, 1, 2
_ROWS = ("block long, kind int, bucket int, doc_ids array<long>, sizes binary, data binary, "
         "home long")


_COMMON = 128  # numbers below this take one byte


def _short(values: np.ndarray) -> bytes:
    """Numbers of which most are small, as bytes: one for each, which for the larger ones says
    where they lie, and the rest of those side by side."""
    large = values[values >= _COMMON].astype(np.uint32) - _COMMON
    shift = 8
    while len(large) and int(large.max()) >> shift >= 256 - _COMMON:
        shift += 1
    first = values.astype(np.uint32)
    first[values >= _COMMON] = _COMMON + (large >> shift)
    rest = large & ((1 << shift) - 1)
    head = np.array([len(values), shift], "<u4")
    return b"".join((head.tobytes(), first.astype(np.uint8).tobytes(),
                     (rest & 255).astype(np.uint8).tobytes(),
                     (rest >> 8).astype("<u2" if shift > 16 else np.uint8).tobytes()))


def _from_short(raw: bytes) -> np.ndarray:
    n, shift = np.frombuffer(raw, "<u4", 2).tolist()
    out = np.frombuffer(raw, np.uint8, n, 8).astype(np.uint32)
    large = out >= _COMMON
    m = int(large.sum())
    low = np.frombuffer(raw, np.uint8, m, 8 + n).astype(np.uint32)
    high = np.frombuffer(raw, "<u2" if shift > 16 else np.uint8, m, 8 + n + m).astype(np.uint32)
    out[large] = ((out[large] - _COMMON) << shift) + low + (high << 8) + _COMMON
    return out


def _row_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.binary(),
             pa.int64()]
    columns = list(zip(*rows, strict=True)) or [()] * 7
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                           names=[f.split()[0] for f in _ROWS.split(", ")])


def _blocks(docs: DataFrame, path: str, buckets: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, pack = WordFile.at(path), zstandard.ZstdCompressor(level=3).compress
        split, number = TaskContext.get().partitionId(), 0
        codes, held, chars = _Codes(), [], 0

        def closed() -> Iterator[pa.RecordBatch]:
            block, home = (split << 24) + number, split + 31 * number
            words = list(codes)
            uses = np.zeros(len(words), np.int64)
            for _, _, positions in held:
                uses += np.bincount(positions, minlength=len(words))
            often = np.argsort(-uses, kind="stable")
            place = np.empty(len(words), np.uint32)
            place[often] = np.arange(len(words), dtype=np.uint32)
            for ids, counts, positions in held:
                yield _row_batch([(block, _POSITIONS, 0, ids, counts.tobytes(),
                                   pack(_short(place[positions])), home)])
            words = [words[i] for i in often]
            bucket = np.fromiter((xxhash.xxh3_64_intdigest(w.encode()) % buckets for w in words),
                                 np.uint32, len(words))
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            rows = [(block, _ORDER, 0, None, None, pack(bucket.tobytes()), home)]
            for b in np.flatnonzero(np.diff(cuts)).tolist():
                own = " ".join(words[i] for i in order[cuts[b]:cuts[b + 1]])
                rows.append((block, _WORDS, b, None, None, pack(own.encode()), home))
            yield _row_batch(rows)

        for batch in T.rows(batches, 256):
            found = [file.words(t) for t in batch.column(1).to_pylist()]
            counts = np.fromiter(map(len, found), np.uint32, len(found))
            positions = [np.fromiter(map(codes.__getitem__, w), np.uint32, len(w)) for w in found]
            held.append((batch.column(0).to_pylist(), counts, np.concatenate(positions)))
            chars += int(counts.sum()) * 6
            if chars >= BLOCK_CHARS:
                yield from closed()
                codes, held, chars, number = _Codes(), [], 0, number + 1
        if held:
            yield from closed()

    return T.texts(docs).mapInArrow(cut, _ROWS)


def _encoded(words: DataFrame, path: str, buckets: int, tasks: int) -> DataFrame:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = WordFile.at(path)
        pack = zstandard.ZstdCompressor(level=1).compress
        unpack = zstandard.ZstdDecompressor().decompress
        known: dict[str, list[int]] = {}
        current = None
        for batch in T.rows(batches, 64):
            out = []
            for row in batch.to_pylist():
                if row["bucket"] != current:
                    known, current = {}, row["bucket"]
                own = unpack(row["data"]).decode().split(" ")
                new = [w for w in own if w not in known]
                known.update(zip(new, file.ids(new), strict=True))
                ids = [known[w] for w in own]
                sizes = np.fromiter(map(len, ids), np.uint32, len(ids))
                flat = np.fromiter((i for one in ids for i in one), "<u4", int(sizes.sum()))
                out.append((row["block"], _WORDS, row["bucket"], None, pack(sizes.tobytes()),
                            pack(flat.tobytes()), row["home"]))
            yield _row_batch(out)

    dealt = (words.repartitionById(tasks, F.pmod("bucket", F.lit(tasks)).cast("int"))
             .sortWithinPartitions("bucket"))
    return dealt.mapInArrow(encode, _ROWS)


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit) and decoded (text of the ids) of every text.

    ``tokenizer``: path of a tokenizers file of whole-word pieces, readable on every executor.
    ``decoded`` is the ids' pieces, special ones included, with a space between.

    A null text counts as empty and has no ids; a null doc_id is kept; repeated rows are encoded
    once each; extra columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    buckets = 4 * tasks
    blocks = T.written(_blocks(docs, tokenizer, buckets), "word-blocks")
    ids = _encoded(blocks.where(F.col("kind") == _WORDS), tokenizer, buckets, tasks)
    both = ids.unionByName(blocks.where(F.col("kind") != _WORDS))
    home = (both.repartitionById(tasks, F.pmod("home", F.lit(tasks)).cast("int"))
            .sortWithinPartitions("block", "kind", "bucket"))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = WordFile.at(tokenizer).pieces
        unpack = zstandard.ZstdDecompressor().decompress
        bucket, id_bytes, id_text = np.empty(0, np.uint32), [], []
        for batch in T.rows(batches, 16):
            for row in batch.to_pylist():
                if row["kind"] == _ORDER:
                    bucket = np.frombuffer(unpack(row["data"]), np.uint32)
                    id_bytes, id_text = [b""] * len(bucket), [b""] * len(bucket)
                    continue
                if row["kind"] == _WORDS:
                    flat = np.frombuffer(unpack(row["data"]), "<u4")
                    ends = np.cumsum(np.frombuffer(unpack(row["sizes"]), np.uint32)).tolist()
                    texts, at = list(map(pieces.__getitem__, flat.tolist())), 0
                    raw = flat.tobytes()
                    places = np.flatnonzero(bucket == row["bucket"]).tolist()
                    for place, end in zip(places, ends, strict=True):
                        id_bytes[place] = raw[4 * at:4 * end]
                        id_text[place] = b"".join(t + b" " for t in texts[at:end])
                        at = end
                    continue
                positions = _from_short(unpack(row["data"]))
                all_ids, decoded, at = [], [], 0
                for count in np.frombuffer(row["sizes"], np.uint32).tolist():
                    own = positions[at:at + count].tolist()
                    all_ids.append(b"".join(map(id_bytes.__getitem__, own)))
                    decoded.append(b"".join(map(id_text.__getitem__, own))[:-1].decode())
                    at += count
                yield pa.record_batch(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(all_ids, pa.binary()),
                     pa.array(decoded, pa.string())], names=["doc_id", "ids", "decoded"])

    return home.mapInArrow(joined, "doc_id long, ids binary, decoded string")
