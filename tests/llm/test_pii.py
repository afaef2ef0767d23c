"""Base spans against the plain patterns run by another engine."""

import hashlib
import random
import re

from faultline.llm import pii, queries

PLAIN = [
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")),
]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def passes(kind, span):
    digits = re.sub("[^0-9]", "", span)
    if kind == "ip":
        return all(int(x) <= 255 for x in span.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def base(text):
    found = [(k, m) for k, p in PLAIN for m in p.finditer(text or "") if passes(k, m.group())]
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, m in found)


def check(rows, texts):
    for r in rows:
        want = base(texts[r.doc_id])
        assert r.spans.startswith(want), (texts[r.doc_id][:200], want, r.spans)
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert r.n_email + r.n_ip + r.n_card + r.n_phone == want.count(":") // 2


def test_query(spark, sf, texts):
    rows = queries.queries()["op4_pii"](spark, sf).collect()
    assert len(rows) == len(texts)
    check(rows, texts)


def test_odd_texts(spark, tmp_path):
    rng = random.Random(5)
    texts = ["", None, "1.2.3.4.5.6.7.8", "a@b.c_d@e.f", "é 4111 1111 1111 1111 x@y.z 😀 +1 (415) 555-2671", "0.0.0.256 000.001.255.9"]
    texts += ["1.1.1.1 " * 700, "a@b." + "c." * 900 + "d", "1 " * 900, "+1" + "2" * 900, "a@b.c@d.e", "4111--1111", "a" * 2000 + "@"]
    texts += ["".join(rng.choice("ab.@12 +-()_%é😀\n3") for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    texts = dict(enumerate(texts))
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.queries()["op4_pii"](spark, str(tmp_path)).collect()
    assert len(rows) == len(texts)
    check(rows, texts)


def test_long_texts_end(spark):
    """Runs and repetitions of 100,000 signs neither overflow the stack nor take quadratic time."""
    texts = ["a" * 200_000 + " @", "1" * 200_000, "a@b." + "c." * 100_000 + "d", "1 " * 100_000, "+1 " * 100_000, "1.1.1.1 " * 20_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in pii.find(df).collect()}
    assert len(rows[2].email) == 1 and len(rows[5].ip) == 20_000 and rows[5].ip[-1].end == 8 * 20_000 - 1


def test_checksums_and_context(spark):
    texts = ["GB82 WEST 1234 5698 7654 32", "my bank iban GB82 WEST 1234 5698 7654 32 ok", "GB83 WEST 1234 5698 7654 32", "DE89370400440532013000"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: [tuple(s) for s in r.iban] for r in pii.find(df).collect()}
    assert rows == {0: [(0, 27, 70 + 0)], 1: [(13, 40, 90)], 2: [], 3: [(0, 22, 70)]}


def test_edges(edges, none):
    rows = pii.find(edges).collect()
    assert len(rows) == edges.count() and not any(r.email or r.ip or r.card or r.phone for r in rows)
    assert pii.find(none).count() == 0
