from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from footfall.llm import divergence, queries
from tests.compare import differences, duck
from tests.llm.conftest import SMALL

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def _words(text):
    return TERM.findall((text or "").translate(UPPER))


def _by_hand(rows, top=10, documents=10):
    """Rows (lang, source, text) to the rows of the audit."""
    groups, seen = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        groups[lang or "", source or ""].update(_words(text))
        seen[lang or ""].update(set(_words(text)))
    out = []
    for lang in seen:
        kept = sorted((w for w, n in seen[lang].items() if n >= documents), key=str.encode)
        mine = {s: c for (x, s), c in groups.items() if x == lang}
        whole = sum(mine.values(), Counter())

        def rates(counts, kept=kept):
            below = sum(counts[w] for w in kept) + 2 * len(kept)
            return {w: 1 + 10**9 * (counts[w] + 2) // below for w in kept}

        def f(p, q):
            return (p - q) ** 2 // (p + q)

        q = rates(whole)
        for source, counts in mine.items():
            p = rates(counts)
            terms = [(-f(p[w], q[w]), w.encode(), w) for w in kept if counts[w] and p[w] > q[w]]
            out += [(lang, source, "term", w, -v, n + 1)
                    for n, (v, _, w) in enumerate(sorted(terms)[:top])]
            pairs = []
            for other in mine:
                if other != source:
                    r = rates(mine[other])
                    pairs.append((-sum(f(p[w], r[w]) for w in kept), other.encode(), other))
            out += [(lang, source, "pair", s, -v, n + 1)
                    for n, (v, _, s) in enumerate(sorted(pairs))]
    return sorted(out)


def _run(spark, rows, **more):
    frame = spark.createDataFrame([(i, t, x, s, 7, 1) for i, (x, s, t) in enumerate(rows)],
                                  "doc_id long, text string, lang string, source string, "
                                  "term long, n long")
    return sorted(map(tuple, divergence.audit(frame).collect()))


def test_query_equals_sql(spark):
    query = queries.op11_source_divergence(spark, SMALL)
    assert differences(query, duck(SMALL), queries.oracle_sql()["op11_source_divergence"]) == []


def _corpus(seed, groups=7, rows=300):
    rng = random.Random(seed)
    words = [w for w in "the of and Été été straße ÜBER naïve zz ça 数据 a b c d e f g h".split()]
    words += [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)]
    weights = [1 / (i + 1) for i in range(len(words))]
    out = []
    for _ in range(rows):
        source = f"s{min(rng.randrange(groups), rng.randrange(groups))}"
        own = rng.choices(words, weights, k=rng.randrange(60))
        out.append((rng.choice(["en", "de"]), source, rng.choice([" ", ", ", "1-"]).join(own)))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = _corpus(seed)
    assert _run(spark, rows) == _by_hand(rows)


def test_small_blocks_and_few_held_counters(spark, monkeypatch):
    rows = _corpus(3, groups=9)
    frame = spark.createDataFrame([(t, x, s) for x, s, t in rows],
                                  "text string, lang string, source string")
    monkeypatch.setattr(divergence, "HELD", 50)
    monkeypatch.setattr(divergence, "TERMS", 7)
    kept = divergence.kept_terms(frame).cache()
    totals = divergence.group_totals(frame, kept).cache()
    for block in (2, 3):
        got = divergence.pair_divergence(kept, totals, block).collect()
        assert sorted(map(tuple, got)) == [r for r in _by_hand(rows) if r[2] == "pair"]


def test_odd_rows(spark):
    rows = [(None, None, None), ("", "", ""), ("en", "a", None), ("en", None, "x" * 50_000),
            ("fr", "lonely", "un deux")] + [("en", "a", "Alpha beta")] * 12
    rows += [("en", "b", "beta beta " + "gamma " * 5000)] * 11 + [("xx", "p", "1 2"), ("xx", "q", "")]
    assert _run(spark, rows) == _by_hand(rows)
    assert _run(spark, []) == []


def test_group_without_terms_is_compared(spark):
    rows = [("en", "a", "one two")] * 10 + [("en", "b", "")]
    got = _run(spark, rows)
    assert got == _by_hand(rows)
    assert {(r[1], r[3]) for r in got if r[2] == "pair"} == {("a", "b"), ("b", "a")}


def test_skyband_keeps_what_fewer_than_k_dominate():
    rng = random.Random(5)
    for k in (1, 3, 10):
        items = [(rng.randrange(9), rng.randrange(9), f"t{i:03d}") for i in range(200)]
        ordered = sorted(items, key=lambda x: (-x[0], x[1], x[2]))
        band = divergence.Skyband(k)
        got = [x for x in ordered if band.keeps(x[1], x[2])]
        want = [x for x in ordered if sum(
            y[0] >= x[0] and y[1] <= x[1] and y[2] < x[2] for y in items) < k]
        assert got == want


def test_parts_of_a_skyband_lose_nothing(spark):
    rows = _corpus(8, rows=200)
    frame = spark.createDataFrame([(t, x, s) for x, s, t in rows],
                                  "text string, lang string, source string")
    kept = divergence.kept_terms(frame).cache()
    whole = sorted(map(tuple, divergence.skyband(kept, 3, parts=1).collect()))
    assert whole == sorted(map(tuple, divergence.skyband(kept, 3, parts=16).collect()))
    assert 0 < len(whole) < kept.count()


def test_rates_beyond_64_bits(spark):
    big = 1 << 62
    got = spark.createDataFrame([(big, big + 5, 3)], "n long, total long, vocabulary long").select(
        divergence.rate("n", "total")).first()[0]
    assert got == 1 + 10**9 * (big + 2) // (big + 5 + 6)
    import numpy as np
    assert divergence._rates(np.array([big]), big + 5, 3).tolist() == [got]
