from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from footfall.llm import queries, word_tokens
from footfall.llm.byte_tokens import ByteTokens
from tests.llm.conftest import ODD, SMALL

PATH = public_tokenizers.path("word_bpe_49k.json")
LETTERS = "aAbzß éÉİŉſΣσςКд中٣²½ªº'!<|>\n\t\x1c\x85\xa0  🙂é̀ŸȺ\x00\x7f\xad'st'll're1"


def _want(text):
    tokenizer = Tokenizer.from_file(PATH)
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    return np.array(ids, "<u4").tobytes(), tokenizer.decode(ids, skip_special_tokens=False)


def test_ids_and_decoded_text(documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    got = {r.doc_id: (bytes(r.ids), r.decoded)
           for r in word_tokens.encode(documents, PATH).collect()}
    assert got == {i: _want(t) for i, t in texts.items()}


def test_small_blocks(documents, monkeypatch):
    monkeypatch.setattr(word_tokens, "BLOCK_CHARS", 5000)
    got = {r.doc_id: bytes(r.ids) for r in word_tokens.encode(documents, PATH).collect()}
    assert got == {r.doc_id: _want(r.text)[0] for r in documents.collect()}


def test_odd_documents(odd):
    got = sorted((str(r.doc_id), bytes(r.ids), r.decoded)
                 for r in word_tokens.encode(odd, PATH).collect())
    assert got == sorted((str(r[0]), *_want(r[1])) for r in ODD)
    assert word_tokens.encode(odd.limit(0), PATH).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_words_of_any_text(seed):
    rng = random.Random(seed)
    file = word_tokens.WordFile.at(PATH)
    exact = ByteTokens.at(public_tokenizers.path("byte_bpe_50k.json"))
    for _ in range(400):
        text = "".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 20)))
        text += rng.choice(["", "", "<|endoftext|>" + text[:3] + "<|startoftext|>"])
        ids = [i for one in file.ids(file.words(text)) for i in one]
        assert np.array(ids, "<u4").tobytes() == _want(text)[0]
        other = exact.exact.encode(text, add_special_tokens=False).ids
        assert exact(text) == np.array(other, "<u4").tobytes()


@pytest.mark.parametrize("n, most", [(0, 5), (9, 100), (99, 129), (999, 40_000), (999, 2**31)])
def test_short_numbers(n, most):
    values = np.random.default_rng(n).integers(0, most, n).astype(np.uint32)
    assert word_tokens._from_short(word_tokens._short(values)).tolist() == values.tolist()


def test_query(spark):
    assert queries.op4_bpe(spark, SMALL).columns == [
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
