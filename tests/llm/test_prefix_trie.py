from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from footfall.llm import prefix_trie, queries
from tests.compare import differences, duck
from tests.llm.conftest import SMALL

SCHEMA = "conv_id long, turn long, role string, text string, depth string, band string, path long"


def _by_hand(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[conv].append(((turn is not None, turn or 0), role, digest, text))
    own = {c: [(r, t) for _, r, _, t in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        rebuilt[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c in sorted(rebuilt):
        for d in range(len(rebuilt[c]) + 1):
            members[rebuilt[c][:d]].append(c)
    children = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, inside in members.items():
        words = len(re.findall("[^\x20\x09-\x0d]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(inside) - 1) * words
    return sorted((
        inside[0], len(node), members[node[:-1]][0] if node else None, len(inside),
        children[node], leaves[node], saved[node],
        hashlib.sha256(",".join(str(c) for c in inside if rebuilt[c] == node).encode()).hexdigest(),
    ) for node, inside in members.items()) if members else []


def _run(spark, rows, **more):
    frame = spark.createDataFrame([(*r, "x", "y", 3) for r in rows], SCHEMA)
    return sorted(map(tuple, prefix_trie.trie(frame, **more).collect()))


def _key(rows):
    return sorted(rows, key=str)


def _conversations(seed, n=120, deepest=12, texts=3):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        conv = rng.randrange(-50, 400)
        if any(r[0] == conv for r in rows):
            continue
        for turn in range(rng.randrange(1, deepest)):
            rows.append((conv, turn, ("user", "assistant")[turn % 2],
                         " ".join(["word"] * rng.randrange(1, texts))))
    rng.shuffle(rows)
    return rows


def test_query_equals_sql(spark):
    query = queries.op13_prefix_trie(spark, SMALL)
    assert differences(query, duck(SMALL), queries.oracle_sql()["op13_prefix_trie"]) == []


@pytest.mark.parametrize("height", [2, 3, 32])
def test_against_brute_force(spark, height):
    rows = _conversations(height)
    assert _key(_run(spark, rows, height=height)) == _key(_by_hand(rows))


def test_long_conversations_take_several_levels(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 7)
    rows = [(c, t, "user", f"turn {t}") for c in (1, 2, 3, 20) for t in range(60 + c)]
    rows += [(3, 63 + t, "user", f"own {t}") for t in range(20)]
    assert _key(_run(spark, rows, height=3)) == _key(_by_hand(rows))


def test_odd_rows(spark):
    rows = [(None, 0, "user", "lost"), (1, None, None, None), (1, None, "user", " \t"),
            (1, 0, "user", ""), (2, 5, "user", "x" * 50_000), (2, 5, "user", "x" * 50_000),
            (2, 5, "assistant", "y"), (2, -3, "z", "中文 é ☃ word"), (45, 1, "a", "word " * 20_000),
            (-7, 1, "user", "below"), (-20, 1, "user", "base"), (-20, 2, "user", "base two"),
            (10**15, 10**12, "user", "far")]
    assert _key(_run(spark, rows)) == _key(_by_hand(rows))
    assert _run(spark, []) == []
    assert _run(spark, [(None, 1, "user", "x")]) == []


def test_turnless_conversation_is_a_member_of_the_root(spark):
    alone = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 >= 1)
    rows = [(alone, 0, "user", "hello there")]
    got = _run(spark, rows)
    assert got == _by_hand(rows)
    assert got == [(alone, 0, None, 1, 0, 1, 0,
                    hashlib.sha256(str(alone).encode()).hexdigest())]


def test_many_copies_of_one_conversation(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS", 5)
    rows = [(c * 20, t, "user", "same words here") for c in range(200) for t in range(3)]
    got = _run(spark, rows)
    assert _key(got) == _key(_by_hand(rows))
    assert [r[3] for r in got] == [200] * 4


def test_role_and_text_do_not_run_together(spark):
    rows = [(0, 0, "user", "a"), (20, 0, "use", "ra"), (40, 0, "", "usera")]
    assert len(_run(spark, rows)) == len(_by_hand(rows)) == 4
