"""Ids of a byte-level tokenizers file, without keeping more than one text's ids."""

from __future__ import annotations

import base64
import json
import os
import re

import numpy as np
import tiktoken
from tokenizers import Tokenizer

# Code points whose classes (letter, digit, space) are the same for every library used here.
PLAIN = re.compile("[\t\n\r\x20-\x7e\xa0-ɏ]*")
# The split pattern of byte-level files with the usual pre-tokenizer (fixed value).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The printable letter that byte-level files write for each byte, and back."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in own}
    for n, b in enumerate(sorted(set(range(256)) - set(own))):
        letters[chr(256 + n)] = b
    return letters


class ByteTokens:
    """Encodes as the tokenizers library does with add_special_tokens=False.

    The vocabulary is read from the tokenizers file alone. Plain texts go through tiktoken's
    merge loop, which is several times faster and gives the same ids; a text with other code
    points or with an added token's string goes through the tokenizers library.
    """

    _made: dict[str, ByteTokens] = {}

    @classmethod
    def at(cls, path: str) -> ByteTokens:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.exact = Tokenizer.from_file(path)
        self.exact.no_truncation()
        self.exact.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.added = [t["content"] for t in spec["added_tokens"]]
        byte = byte_letters()
        skip = set(self.added)
        ranks = {bytes(byte[c] for c in piece): i
                 for piece, i in spec["model"]["vocab"].items() if piece not in skip}
        self.fast = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks,
                                      special_tokens={})

    def __call__(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if PLAIN.fullmatch(text) and not any(t in text for t in self.added):
            return self.fast.encode_to_numpy(text).astype("<u4").tobytes()
        ids = self.exact.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()
