from __future__ import annotations

from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from footfall.llm import packing, queries
from tests.llm.conftest import SMALL

PATH = public_tokenizers.path("byte_bpe_50k.json")


def _ids(text):
    found = Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids
    return [*found, 0]


def _check(pieces, texts):
    """Each id lies in one piece, sequences have no gaps; returns the share of padding."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
        assert p.length == len(p.ids) // 4 > 0
    for doc_id, text in texts.items():
        own = sorted(by_doc[doc_id], key=lambda p: p.start)
        ids = np.frombuffer(b"".join(bytes(p.ids) for p in own), "<u4").tolist()
        assert ids == _ids(text)
        assert all(p.doc_tokens == len(ids) for p in own)
        assert [p.start for p in own] == list(np.cumsum([0, *(p.length for p in own)])[:-1])
    used = 0
    for own in by_sequence.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == list(np.cumsum([0, *(p.length for p in own)])[:-1])
        assert sum(p.length for p in own) <= 1024
        used += sum(p.length for p in own)
    return 1 - used / (1024 * len(by_sequence))


def test_documents_are_packed_whole(documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    assert _check(packing.pack(documents, PATH).collect(), texts) < 0.02


def test_odd_documents(docs):
    texts = {1: None, 2: "", 3: " \n", 4: "word " * 3000, 5: "<|endoftext|>x", 6: "é中☃" * 50}
    _check(packing.pack(docs(*texts.items()), PATH).collect(), texts)


def test_repeated_rows_and_empty_table(docs):
    assert packing.pack(docs((1, "a"), (1, "a"), (None, "b")), PATH).count() == 3
    assert packing.pack(docs((1, "a")).limit(0), PATH).count() == 0


def test_differencing_balances():
    sizes = np.random.default_rng(3).integers(1, 257, 900)
    at = packing.differencing(sizes, 100)
    sums = np.bincount(at, sizes, 100)
    assert sums.sum() == sizes.sum() and sums.max() - sums.min() <= 20
    # Two windows, by hand: 8 and 7 differ by 1, 6 and 5 by 1, 4 joins the lighter side.
    sums = np.bincount(packing.differencing(np.array([8, 7, 6, 5, 4]), 2), [8, 7, 6, 5, 4])
    assert sorted(sums) == [14, 16]


def test_window_count_rises_when_capacity_is_exceeded():
    at, windows = packing.deal(np.array([6, 6, 6, 2]), 10)
    assert windows == 3 and np.bincount(at, [6, 6, 6, 2]).max() <= 10


def test_query(spark):
    columns = queries.op1_packing(spark, SMALL).columns
    assert columns[:7] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                           "offset"]
