from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from footfall.llm import pii, queries
from tests.llm.conftest import SMALL

# The base patterns as the contract has them.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _by_hand(text):
    out = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                "card": lambda: 14 <= len(digits) <= 19 and pii.luhn(digits),
                "phone": lambda: 10 <= len(digits) <= 15,
            }[kind]()
            if good:
                out.append((m.start(), order, kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(out)]


@pytest.mark.parametrize("letters", ["ab@.1", "12.+ ()-", "0123456789 -.", "a1@.-+ é%"])
def test_base_spans_of_any_text(letters):
    rng = random.Random(letters)
    for _ in range(8000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(text) == _by_hand(text)


def test_long_runs_are_fast():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 100_000, "+1 " * 100_000, "@" * 200_000):
        pii.base_spans(text)


def test_query(spark, documents):
    got = {r.doc_id: r for r in queries.op6_pii(spark, SMALL).collect()}
    digest = {}
    for row in documents.collect():
        spans = _by_hand(row.text or "")
        digest[row.doc_id] = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        out = got[row.doc_id]
        counts = (out.n_email, out.n_ip, out.n_card, out.n_phone)
        assert counts == tuple(sum(k == kind for k, _, _ in spans) for kind in PATTERNS)
        assert set(digest[row.doc_id].split(",")) - {""} <= set(out.spans.split(","))
    wanted = spark.createDataFrame(list(digest.items()), "doc_id long, base string")
    for row in wanted.select("doc_id", F.sha2("base", 256).alias("h")).collect():
        assert got[row.doc_id].base_sha256 == row.h


def _corpus():
    rows = [(i, f"Meeting {i} with Quillon{i} at place {i % 7} about matter {i}") for i in range(60)]
    for i in range(5):
        rows.append((100 + i, f"note {i} from Zorblatt mail zb@x.org regards file {i}"))
    rows.append((200, "Yesterday Zorblatt called about a meeting at place 3"))
    return rows


def test_disclosing_terms_are_generalised(docs):
    rows = {r.doc_id: r for r in pii.sanitise(docs(*_corpus())).collect()}
    text = dict(_corpus())
    # The name stands by the address in five different texts and nearly nowhere else.
    assert "Zorblatt" not in rows[200].text
    assert rows[200].n_email == 0 and rows[200].spans == "term:10:18"
    assert rows[103].spans.startswith("term:") and "email:" in rows[103].spans
    assert "zb@x.org" not in rows[103].text
    for i in range(60):
        assert rows[i].text == text[i] and rows[i].spans == ""


def test_copies_are_no_evidence(docs):
    rows = [(i, "note from Zorblatt mail zb@x.org regards") for i in range(9)]
    rows += [(100 + i, f"other text {i}") for i in range(30)]
    assert {r.spans.split(":")[0] for r in pii.sanitise(docs(*rows)).collect()} == {"email", ""}


def test_disclosure_by_hand(docs):
    terms = pii.disclosing_terms(docs(*_corpus())).collect()
    # IC(e) = -log2(5/67); PMI = log2(5*67 / (5*with_term)).
    from math import log2
    rates = sorted({round(t.disclosure, 6) for t in terms})
    assert round(log2(67 / 6) / log2(67 / 5), 6) in rates and max(rates) == 1.0


def test_odd_documents(odd, docs):
    rows = pii.sanitise(odd, carry=("lang", "source"))
    assert rows.count() == 11
    assert {r.text for r in rows.where("doc_id < 3").collect()} == {""}
    assert pii.sanitise(odd.limit(0)).count() == 0
    same = pii.sanitise(docs((1, "a@b.cd"), (1, "a@b.cd"))).collect()
    assert [(r.text, r.spans) for r in same] == [("[EMAIL]", "email:0:6")] * 2


def test_overlapping_spans_are_masked_once():
    text = "+1.2.3.4 55555555 x"
    base = pii.base_spans(text)
    assert len(base) >= 2
    out = pii._result(text, base, [])[0]
    assert not re.search("[0-9]", out) and out.endswith(" x")


def test_numbers_and_short_names_are_terms(docs):
    rows = [(i, f"Meeting {i} at place {i % 7} on the matter {i + 500}") for i in range(60)]
    rows += [(100 + i, f"order {i} of 4711 by Li w@x.org {'abcde'[i]}{i}") for i in range(5)]
    rows += [(200, "Ask Li whether 4711 was paid")]
    out = {r.doc_id: r for r in pii.sanitise(docs(*rows)).collect()}
    assert "4711" not in out[200].text and "Li" not in out[200].text.split()
    assert out[200].spans == "term:4:6,term:15:19"
    assert all(out[i].spans == "" for i in range(60))


def test_terms_far_from_the_entity(docs):
    """A number at the other end of the documents that hold the address."""
    rows = [(i, f"meeting {i} at place {i % 7}") for i in range(60)]
    filler = [" ".join(f"{w}{i}" for w in "abcdefghij") for i in range(5)]
    rows += [(100 + i, f"account 884422 {filler[i]} w@x.org {filler[i]}") for i in range(5)]
    rows += [(200, "who pays 884422 now")]
    out = {r.doc_id: r for r in pii.sanitise(docs(*rows)).collect()}
    assert out[200].spans == "term:9:15"
    # One document that repeats an address is no evidence about its other words.
    once = [(1, f"account 884422 {filler[0]} w@x.org {' w@x.org '.join(filler)}")]
    out = {r.doc_id: r.spans for r in pii.sanitise(docs(*once, *rows[:60])).collect()}
    assert "term" not in out[1]
