from __future__ import annotations

import re

from footfall.llm import licences, license_scan, queries
from tests.llm.conftest import SMALL


def test_every_notice_is_found(spark, documents):
    got = {(r.doc_id, r.template) for r in queries.op2_license_scan(spark, SMALL).collect()}
    want = {(r.doc_id, name) for r in documents.collect()
            for name, notice in license_scan.NOTICES.items()
            if re.search(re.escape(notice.rstrip(".")), r.text or "")}
    assert want <= got
    assert got == want


def test_places_and_containment(docs):
    text = "é some words. Released under the MIT license! More. Released under The MIT License"
    rows = license_scan.scan(docs((1, text))).collect()
    assert [(text[r.start:r.end].lower(), r.template, r.containment) for r in rows] == [
        ("released under the mit license", "mit", 1.0)] * 2
    changed = "This work is licensed under the GNU General Public License, edition 3."
    row = license_scan.scan(docs((1, changed))).first()
    assert row.template == "gpl-3.0" and 0.8 <= row.containment < 1
    assert license_scan.scan(docs((1, "Released for the MIT people"))).count() == 0


def test_containment_agrees_with_brute_force(docs):
    """Windows with one word changed: exactly those that hold enough shingles are found."""
    words = license_scan.NOTICES["gpl-3.0"].split()
    texts = {i: " ".join("other" if k == i else w for k, w in enumerate(words))
             for i in range(len(words))}
    got = {r.doc_id for r in license_scan.scan(docs(*texts.items())).collect()}
    n = len(words) - 1
    want = {i for i in texts if (n - (1 if i in (0, n) else 2)) / n >= 0.8}
    assert got == want


def test_odd_documents(odd, docs):
    assert license_scan.scan(odd).count() == 0
    notice = "Licensed under CC BY-NC 4.0."
    assert license_scan.scan(docs((1, notice), (1, notice), (None, notice))).count() == 3
    assert license_scan.scan(odd.limit(0)).count() == 0
    twice = {"a": notice, "b": notice}
    assert {r.template for r in license_scan.scan(docs((1, notice)), twice).collect()} == {"a", "b"}


def _templates(docs, text):
    return {r.template for r in license_scan.scan(docs((1, text))).collect()}


def test_short_notices_with_one_changed_word(docs):
    assert _templates(docs, "Code: Licensed under the MIT License.") == {"mit"}
    assert _templates(docs, "Licensed under the CC BY 4.0, as is") == {"cc-by-4.0"}
    assert _templates(docs, "Released under CC BY-NC 4.0") == {"cc-by-nc-4.0"}
    assert _templates(docs, "Licensed under the Apache Licence 2.0") == {"apache-2.0"}
    # The words that name a licence must all be there, and no more than one other may differ.
    assert _templates(docs, "Licensed under the Apache License, Version 1.1") == set()
    assert _templates(docs, "The MIT License was written at a university") == set()


def test_headers_and_whole_texts(docs):
    wordings = licences.wordings()
    for name in ("mit-text", "isc-text", "apache-2.0-header", "gpl-3.0-header", "lgpl-2.1-header",
                 "agpl-3.0-header", "bsd-2-clause-text", "cc0-1.0-text", "gpl-2.0-text"):
        want = {n for n, _ in license_scan.parts(name, license_scan._WORD.findall(wordings[name]))}
        assert want <= _templates(docs, f"Some words before. {wordings[name]} And after."), name
    assert "mit-identifier" in _templates(docs, "# SPDX-License-Identifier: MIT\nimport os")


def test_parts_cover_a_long_template():
    words = [str(i) for i in range(100)]
    cut = [w for _, w in license_scan.parts("t", words)]
    assert all(len(w) == license_scan.PART for w in cut) and set(sum(cut, [])) == set(words)
