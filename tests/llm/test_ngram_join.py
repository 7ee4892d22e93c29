from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest

from footfall.llm import ngram_join, queries
from footfall.llm import text as T
from footfall.llm.components import components as connected
from tests.compare import differences, duck
from tests.llm.conftest import SMALL, no_broadcast, shuffled

UPPER = {c: c + 32 for c in range(65, 91)}


def _set(text, words):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    if len(found) < words:
        return frozenset([tuple(found)] if found else [])
    return frozenset(zip(*(found[i:] for i in range(words)), strict=False))


def _by_hand(rows, words, percent):
    """All pairs: doc_id, set size, smallest id reachable."""
    sets = {i: _set(t, words) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return sorted((i, len(sets[i]), find(i)) for i in sets)


def _family(seed):
    """Copies of some texts with more and more words changed, shuffled ids."""
    rng = random.Random(seed)
    rows = []
    for base in range(4):
        words = [f"w{rng.randrange(2000)}" for _ in range(rng.choice([9, 30, 80, 250]))]
        for _ in range(25):
            own = list(words)
            for _ in range(rng.randrange(1 + len(words) // 12)):
                own[rng.randrange(len(own))] = f"n{rng.randrange(9999)}"
            rows.append(" ".join(own if rng.random() < 0.8 else own + own[:5]))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed, words, percent", [(1, 3, 90), (2, 5, 80), (3, 2, 70), (4, 3, 90)])
def test_links_of_edited_copies(docs, seed, words, percent):
    rows = _family(seed)
    got = sorted(map(tuple, ngram_join.components(docs(*rows), words, percent).collect()))
    want = _by_hand(rows, words, percent)
    assert got == want
    assert 1 < max(Counter(c for _, _, c in want).values()) < len(rows)


def test_query_equals_sql(spark):
    query = queries.op7_ngram_join(spark, SMALL)
    assert differences(query, duck(SMALL), queries.oracle_sql()["op7_ngram_join"]) == []


def test_signatures_of_similar_sets_meet():
    """Any two sets that differ by the most that is allowed share a signature."""
    rng = np.random.default_rng(7)
    for percent in (70, 80, 90):
        scheme = ngram_join.Scheme(3, percent)
        for size in (1, 5, 9, 10, 13, 19, 27, 60, 200, 700, 3000):
            for _ in range(20):
                pool = rng.integers(0, 2**63, 2 * size + 2, np.uint64)
                a = np.unique(pool[:size])
                b = a
                for n in range(1, size + 1):  # as far apart as still linked
                    dropped = rng.integers(0, n + 1)
                    c = np.unique(np.concatenate([a[dropped:], pool[size:size + n - dropped]]))
                    if not scheme.linked(a, c):
                        break
                    b = c
                    if n > 12 and rng.random() < 0.2:
                        continue
                if len(b) and not np.array_equal(a, b):
                    assert len(np.intersect1d(scheme.signatures(a), scheme.signatures(b)))
                    both = [np.frombuffer(scheme.sketch(s), np.uint8)[None, :] for s in (a, b)]
                    cells = 8 * min(s.shape[1] for s in both)
                    x, y = (ngram_join.folded(s, cells) for s in both)
                    assert np.bitwise_count(x ^ y).sum() <= scheme.differing(len(a), len(b))


def test_blocks_of_a_large_bucket(docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    rows = _family(5)
    got = sorted(map(tuple, ngram_join.components(docs(*rows), 3, 90).collect()))
    assert got == _by_hand(rows, 3, 90)


def test_odd_documents(odd, docs):
    got = sorted(map(tuple, ngram_join.components(odd, 3, 90).collect()), key=str)
    assert len(got) == 11
    by_id = defaultdict(list)
    for i, n, c in got:
        by_id[i].append((n, c))
    assert by_id[1] == [(0, 1)] and by_id[3] == [(0, 3)] and by_id[4] == [(1, 4)]
    assert by_id[5] == [(1, 5)] * 2 and by_id[None] == [(1, None)] and by_id[6] == [(1, 6)]
    assert ngram_join.components(odd.limit(0)).count() == 0
    # Two short texts are equal or nothing.
    got = ngram_join.components(docs((1, "a b"), (2, "A\tB"), (3, "a c")), 3, 90).collect()
    assert sorted(map(tuple, got)) == [(1, 1, 1), (2, 1, 1), (3, 1, 3)]


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(7, 7)]
    random.Random(1).shuffle(edges)
    got = connected(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted(map(tuple, got)) == [(i, 0) for i in range(41)] + [
        (100 + i, 100) for i in range(30)]
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_signatures_of_nothing_are_rare():
    """Sets with no shingle in common share next to no signature, at any size."""
    rng = np.random.default_rng(11)
    for percent in (80, 90):
        scheme = ngram_join.Scheme(5, percent)
        for size in (40, 60, 117, 231, 453, 1237):
            sets = [np.unique(rng.integers(0, 2**63, size + int(n), np.uint64) * np.uint64(2))
                    for n in rng.integers(0, size // 8, 60)]
            signed = [set(scheme.signatures(s).tolist()) for s in sets]
            met = sum(bool(a & b) for a, b in combinations(signed, 2))
            assert met <= 0.1 * 60 * 59 / 2
            # Bounded work: about one signature for two shingles, by bands and rounds.
            assert sum(map(len, signed)) < 2 * sum(map(len, sets))


def test_repeated_rows_lose_no_link(docs):
    """Rows of one id do not cancel out in what tells a bucket's members."""
    words = [f"w{i}" for i in range(20)]
    a, b = list(words), list(words)
    a[0], a[9], a[19] = "e470_89", "e479_0", "e4719_17"
    b[11], b[13], b[17] = "e3511_26", "e3513_29", "e3517_69"
    rows = [(i, " ".join(text)) for i, text in ((1, a), (1, a), (2, b), (2, b), (3, words))]
    got = ngram_join.components(docs(*rows), 1, 70).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [
        (1, 1), (1, 1), (2, 1), (2, 1), (3, 1)]


def test_rows_without_some_ids(spark, docs):
    rows = docs(*((i, f"text {i}") for i in range(40)), (7, "again"), (None, "no id"))
    ids = spark.createDataFrame([(i,) for i in range(0, 60, 3)], "doc_id long")
    got = ngram_join.without(rows, "doc_id", ids)
    assert got.columns == rows.columns
    want = [r for r in rows.collect() if r.doc_id is None or r.doc_id % 3]
    assert sorted(got.collect(), key=str) == sorted(want, key=str)
    assert ngram_join.without(rows, "doc_id", ids.limit(0)).count() == rows.count()


def test_signatures_are_shuffled_once(spark, documents, monkeypatch):
    """No list of signatures of a set that has no copy, and each of them with its id alone."""
    wide, single, real = [], [], T.written

    def written(df, name, *more):
        for columns, rows in shuffled(df):
            if "signatures" in columns:
                wide.append(rows)
            if "signature" in columns and rows > 20 * documents.count():
                single.append(columns)
        return real(df, name, *more)

    monkeypatch.setattr(T, "written", written)
    with no_broadcast(spark):
        ngram_join.components(documents, 5, 80).count()
    assert sum(wide) < documents.count() / 2
    assert single == [{"signature", "id"}]
