"""Licence scan: MinHash bands over text windows retrieve templates, containment verifies them.

A text's words are cut into overlapping windows of each template's word count. Windows and
templates get MinHash signatures over two-word shingles; a window that agrees with a template in
every row of at least one band is a candidate. With ``bands`` bands of ``rows`` rows, a window
whose Jaccard similarity to a template is s becomes a candidate with probability
1 - (1 - s**rows)**bands: with 32 bands of 2 rows over 0.99999 at 0.6 and over 0.9998 at 0.5.
Candidates are kept if the window holds at least ``containment`` of the template's shingles,
counted exactly. Long templates are cut into parts of PART words, each a template of its own.

One changed word takes two shingles, too much for a notice of SHORT words or fewer. Its windows
are all counted, without bands, and need all words but one, all shingles but two, and every word
that names the licence. Windows that hold too few shingles of any template are left out before.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from footfall.llm import licences
from footfall.llm import text as T

# Customary one-line notices of well-known licences.
NOTICES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "bsd-3-clause": "Redistribution and use in source and binary forms, with or without "
                    "modification, are permitted provided that the following conditions are met",
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "mit": "Released under the MIT License.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, "
               "v. 2.0.",
}
SCHEMA = "doc_id long, template string, start long, end long, shared long, containment double"
PART = 24  # words of a part of a longer template
SHORT = range(4, 10)  # words of a notice that one changed word must not hide
_FILTER = 1 << 20
_WORD = re.compile(r"\w+(?:[-.]\w+)*")


class _Folded(T.WordHashes):
    """Hashes of words in lower case; licence is spelled license."""

    def __missing__(self, word: str) -> int:
        if len(self) >= self.most:
            self.clear()
        folded = word.lower().replace("licenc", "licens")
        value = self[word] = T.xxhash.xxh3_64_intdigest(folded.encode())
        return value


def parts(name: str, words: list[str]) -> Iterator[tuple[str, list[str]]]:
    """A template of at most PART words, or its parts name#1, name#2, ...; the last may overlap."""
    if len(words) <= PART:
        yield name, words
        return
    for n, at in enumerate(range(0, len(words), PART), 1):
        at = min(at, len(words) - PART)
        yield f"{name}#{n}", words[at:at + PART]


class _Template:
    """Shingles of a template or part, and what a window must hold of it."""

    def __init__(self, name: str, words: list[str], hashes: _Folded, containment: float) -> None:
        found = hashes.of(words)
        self.name, self.length = name, len(words)
        self.shingles = np.unique(shingles(found))
        self.least = math.ceil(containment * len(self.shingles) - 1e-9)
        self.words = self.names = np.empty(0, np.uint64)
        self.short = len(words) in SHORT and containment < 1
        if self.short:
            self.least = max(1, min(self.least, len(self.shingles) - 2))
            self.words = np.unique(found)
            self.names = hashes.of([w for w in words[1:] if w != w.lower() or w[0].isdigit()
                                    if w.lower() not in ("license", "licence", "version")])

    def shared(self, near: np.ndarray, words: np.ndarray) -> int:
        """How many shingles the window holds; 0 if too few, or not enough words of a notice."""
        n = int(np.isin(self.shingles, near).sum())
        if n < self.least or (self.short and (
                np.isin(self.words, words).sum() < len(self.words) - 1
                or not np.isin(self.names, words).all())):
            return 0
        return n


def shingles(words: np.ndarray) -> np.ndarray:
    """One hash for each two neighbouring words; a single word is its own shingle."""
    return T.chain_hashes([words[:-1], words[1:]]) if len(words) > 1 else T.mix(words)


class _Group:
    """The templates of one word count, short notices apart."""

    def __init__(self, group: list[_Template], every: np.ndarray) -> None:
        self.templates, self.length, self.short = group, group[0].length, group[0].short
        self.least = max(1, min(t.least for t in group))
        self.known = np.isin(every, np.concatenate([t.shingles for t in group]))
        self.keys: dict[tuple[int, int], list[int]] = {}
        self.flat: list[np.ndarray] = []


class _Templates:
    """Shingles and band keys of the templates, by their word count."""

    def __init__(self, templates: Mapping[str, str], bands: int, rows: int,
                 containment: float) -> None:
        rng = np.random.default_rng(1)
        self.seeds = rng.integers(1, 2**63, bands * rows, np.uint64) | np.uint64(1)
        self.bands, self.rows = bands, rows
        self.hashes = _Folded()
        by_length: dict[int, list[_Template]] = {}
        for whole, notice in sorted(templates.items()):
            for name, words in parts(whole, _WORD.findall(notice)):
                if words:
                    by_length.setdefault(len(words), []).append(
                        _Template(name, words, self.hashes, containment))
        every = [t.shingles for group in by_length.values() for t in group]
        self.every = np.unique(np.concatenate(every)) if every else np.empty(0, np.uint64)
        self.maybe = np.zeros(_FILTER, bool)
        self.maybe[self.every % np.uint64(_FILTER)] = True
        self.groups = [_Group(group, self.every) for group in by_length.values()]
        for group in self.groups:
            if group.short:
                continue
            for i, template in enumerate(group.templates):
                ranks = self.ranks(template.shingles)[:, None, :]
                for band, key in enumerate(self.bands_of(ranks)[0]):
                    group.keys.setdefault((band, int(key)), []).append(i)
            group.flat = [np.array(sorted(k for b, k in group.keys if b == band), np.uint64)
                          for band in range(bands)]

    def ranks(self, shingles: np.ndarray) -> np.ndarray:
        """[seed, shingle]: the order of the shingles under each seed."""
        return T.mix(shingles[None, :] * self.seeds[:, None])

    def bands_of(self, ranks: np.ndarray) -> np.ndarray:
        """[window, band]: keys of windows given as [seed, window, shingle]."""
        least = ranks.min(axis=2).reshape(self.bands, self.rows, -1)
        return T.chain_hashes([least[:, r] for r in range(self.rows)]).T

    def retrieved(self, group: _Group, near: np.ndarray,
                  starts: np.ndarray) -> Iterator[tuple[int, set[int]]]:
        """The windows that agree with a template in a band: its place and their starts."""
        if group.short:
            yield from ((i, set(starts.tolist())) for i in range(len(group.templates)))
            return
        best: dict[int, set[int]] = {}
        width = max(1, group.length - 1)
        for at in range(0, len(starts), 1024):
            part = starts[at:at + 1024]
            places = np.minimum(part[:, None] + np.arange(width), len(near) - 1)
            rows = near[places]
            keys = self.bands_of(self.ranks(rows.ravel()).reshape(-1, *rows.shape))
            for band in range(self.bands):
                for w in np.flatnonzero(np.isin(keys[:, band], group.flat[band])):
                    for i in group.keys[band, int(keys[w, band])]:
                        best.setdefault(i, set()).add(int(part[w]))
        yield from best.items()

    def found(self, text: str) -> Iterator[tuple]:
        words = self.hashes.of(_WORD.findall(text))
        if not len(words) or not len(self.every):
            return
        near = shingles(words)
        hits = np.flatnonzero(self.maybe[near % np.uint64(_FILTER)])
        if not len(hits):
            return
        ids = np.minimum(np.searchsorted(self.every, near[hits]), len(self.every) - 1)
        same = self.every[ids] == near[hits]
        hits, ids = hits[same], ids[same]
        spans: list[re.Match] = []
        for group in self.groups:
            if len(hits) < group.least:
                continue
            own = hits[group.known[ids]]
            width, least = max(1, group.length - 1), group.least
            # Only windows with enough shingles of this length's templates can hold one of them.
            firsts, lasts = own[:max(0, len(own) - least + 1)], own[least - 1:]
            dense = lasts - firsts < width
            if not dense.any():
                continue
            most = max(0, len(near) - width)
            steps = (firsts[dense][:, None] - np.arange(width)[None, :])
            starts = np.unique(np.clip(steps[steps > (lasts[dense] - width)[:, None]], 0, most))
            for i, places in self.retrieved(group, near, starts):
                template = group.templates[i]
                shared = {p: n for p in places
                          if (n := template.shared(near[p:p + width], words[p:p + group.length]))}
                order, end = sorted(shared), -1
                for first in order:
                    if first <= end:
                        continue
                    # Of overlapping windows the one with the most shared shingles stays.
                    spans = spans or list(_WORD.finditer(text))
                    last = min(first + group.length, len(spans)) - 1
                    over = order[bisect_left(order, first):bisect_right(order, last)]
                    n, at = max((shared[p], -p) for p in over)
                    end = min(-at + group.length, len(spans)) - 1
                    yield (template.name, spans[-at].start(), spans[end].end(), n,
                           n / len(template.shingles))


def scan(docs: DataFrame, templates: Mapping[str, str] | None = None, bands: int = 32, rows: int = 2,
         containment: float = 0.8) -> DataFrame:
    """One row for each place in a text that holds a template.

    ``start`` and ``end`` are code points, end exclusive; ``containment`` is the share of the
    template's shingles found there. A null or empty text has none; repeated rows are reported
    once each; equal notices under two names are both reported. Extra columns are ignored.
    ``templates`` go to every task: by default NOTICES and ``licences.wordings()``. One of more
    than PART words is reported part by part, as name#1, name#2, ...
    """
    templates = NOTICES | licences.wordings() if templates is None else dict(templates)

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Templates(templates, bands, rows, containment)
        for batch in T.rows(batches):
            out = [(i, *hit) for i, text in zip(batch.column(0).to_pylist(),
                                                batch.column(1).to_pylist(), strict=True)
                   for hit in known.found(text)]
            names = [f.split()[0] for f in SCHEMA.split(", ")]
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
            columns = list(zip(*out, strict=True)) or [()] * 6
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                  names=names)

    return T.texts(docs).mapInArrow(scanned, SCHEMA)
