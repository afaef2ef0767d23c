"""Licenses found against a search of every window of every text."""

import re
from math import ceil

import pytest
from faultline.llm import licenses, queries

PARSED = licenses._parsed(licenses.TEMPLATES)


def brute(text, templates=PARSED):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    found = set()
    for t in templates:
        n = t.width
        for at in range(0, len(words), t.stride):
            window = words[at : at + t.window]
            held = {tuple(window[i : i + n]) for i in range(len(window) - n + 1)} & set(t.shingles)
            if len(held) >= licenses.CONTAINMENT * len(set(t.shingles)):
                found.add(t.license)
    return found


def test_query(spark, sf, texts):
    rows = queries.queries()["op10_licenses"](spark, sf).collect()
    want = {(i, name) for i, t in texts.items() for name in brute(t)}
    assert want and {(r.doc_id, r.license) for r in rows} == want


def test_edited_notices(spark):
    apache = "You may not use this file except in compliance with the License which you may obtain a copy of the License at the place given here"
    templates = [("long", apache), ("short", "All rights reserved.")]
    words = apache.split()
    texts = ["x " * 37 + " ".join([*words[:k], *words[k + cut :]]) + " y" * 41 for k in (0, 3, 11, 20) for cut in (0, 1, 2)]
    texts += [" ".join(words[:12]), "ALL  RIGHTS,\nreserved!", "all rights are reserved"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.doc_id, r.license) for r in licenses.scan(df, templates).collect()}
    parsed = licenses._parsed(templates)
    assert got == {(i, name) for i, t in enumerate(texts) for name in brute(t, parsed)}
    assert {i for i, _ in got} >= {0, 3, 6, 9, 13} and 12 not in {i for i, _ in got}


def test_gates_leave_nothing_out():
    gates = set(licenses.gate_words(PARSED))
    for t in PARSED:
        shingles = set(t.shingles)
        without = sum(not gates.intersection(s) for s in shingles)
        assert without < ceil(licenses.CONTAINMENT * len(shingles) - 1e-9)


def test_bands_reach_the_recall():
    n = licenses.bands(PARSED)
    for t in PARSED:
        assert 1 - (1 - t.least_similarity**licenses.ROWS) ** n >= licenses.RECALL


def test_edges(spark, edges, none):
    notice = [(None, "Released under the MIT License.", 1), (8, "Released under the MIT License.", 2), (8, "Released under the MIT License.", 2)]
    df = spark.createDataFrame(notice, "doc_id long, text string, start int")
    assert sorted((r.doc_id or -1, r.license) for r in licenses.scan(df).collect()) == [(-1, "mit"), (8, "mit")]
    assert licenses.scan(edges).count() == 0 and licenses.scan(none).count() == 0
    with pytest.raises(ValueError):
        licenses.scan(df, [("empty", "...")])
