"""Collocations against plain counts of every phrase."""

import random
import re
from collections import Counter

import duckdb
import pytest
from faultline.llm import collocations, queries
from pyspark.sql import functions as F

from .conftest import WORDS

DOCS = "doc_id long, text string, lang string"


def brute_counts(rows):
    counts = Counter()
    for _, text, lang in rows:
        text = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    counts[lang if lang is not None else "und", tuple(words[i : i + size])] += 1
    return counts


def brute(rows, top=2000):
    counts = brute_counts(rows)
    total = Counter()
    for (lang, words), n in counts.items():
        if len(words) == 1:
            total[lang] += n
    many = {k: n for k, n in counts.items() if len(k[1]) > 1 and n >= 30}
    gone = set()
    for (lang, words), n in many.items():
        for i in range(len(words)):
            for j in range(i + 2, len(words) + 1):
                if j - i < len(words) and 100 * n >= 80 * many[lang, words[i:j]]:
                    gone.add((lang, words[i:j]))
    out = []
    for (lang, words), a in many.items():
        if (lang, words) in gone:
            continue
        cuts = [(counts[lang, words[:k]], counts[lang, words[k:]], k) for k in range(1, len(words))]
        score, k, l, r = min((2_000_000 * a // (l + r), k, l, r) for l, r, k in cuts)
        out.append((lang, " ".join(words), a, l, r, total[lang], score))
    ranked = []
    for lang in total:
        mine = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))
        ranked += [(lang, n, *x[1:]) for n, x in enumerate(mine[:top], 1)]
    return sorted(ranked)


def test_query_against_plain_counts_and_sql(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang").collect()
    rows = queries.queries()["op11_collocations"](spark, sf)
    got = sorted(map(tuple, rows.collect()))
    assert got and got == brute(docs)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    result = con.execute(queries.OP11_SQL)
    assert rows.columns == [d[0] for d in result.description] and got == sorted(result.fetchall())


def corpus(rng, n):
    ends = [" ", " ", " ", ", ", ".\n", " \t ", "!\r\n", "\x0b"]
    return [
        (i, "".join(rng.choice(WORDS[: 6 + i % 9]) + rng.choice(ends) for _ in range(60)), rng.choice(["en", "de", None, ""]))
        for i in range(n)
    ]


def test_ties_langs_and_separators(spark):
    rows = corpus(random.Random(8), 700) + [(500 + i, "New York is NEW York; éÉ Ünder-way éÉ", "en") for i in range(40)]
    got = collocations.collocations(spark.createDataFrame(rows, DOCS))
    want = brute(rows)
    assert any(len(r[2].split(" ")) > 2 for r in want) and {r[0] for r in want} == {"en", "de", "und", ""}
    assert sorted(map(tuple, got.collect())) == want


@pytest.mark.parametrize("sample, proposed", [(1, 1), (64, 1), (3, 20), (10**9, 1)])
def test_any_sample_gives_the_same(spark, sample, proposed):
    """A sample that proposes nothing, too little or everything only changes the number of passes."""
    rows = corpus(random.Random(9), 150)
    df = spark.createDataFrame(rows, DOCS).select(F.coalesce("lang", F.lit("und")).alias("lang"), "text", (F.col("doc_id") * 7 + 1).alias("chance"))
    found = collocations.frequent(df, 30, sample, proposed).filter("size > 0").collect()
    want = {(lang, " ".join(w)): n for (lang, w), n in brute_counts(rows).items() if n >= 30}
    assert len(found) == len(want) and {(r.lang, r.phrase): r.n for r in found} == want


def test_all_documents_are_read_twice_at_most(spark, monkeypatch):
    """Words, pairs, threes and fours that the sample missed are all counted by the second pass."""
    passes, counts = [], collocations.counts

    def seen(docs, sizes, filters, named=True):
        passes.append(named)
        return counts(docs, sizes, filters, named)

    monkeypatch.setattr(collocations, "counts", seen)
    rows = [(i, "one two three four five" if i % 2 else f"one two {i} three", "en") for i in range(80)]
    df = spark.createDataFrame([(lang, text, 1) for _, text, lang in rows], "lang string, text string, chance long")
    found = collocations.frequent(df, 30, 2, 2).filter("size > 0").collect()  # no document is in the sample
    want = {(lang, " ".join(w)): n for (lang, w), n in brute_counts(rows).items() if n >= 30}
    assert len(found) == len(want) and {(r.lang, r.phrase): r.n for r in found} == want
    assert passes == [False, False, True, True]


def test_small_filters_and_batches(spark, monkeypatch):
    """A filter full of mistakes counts phrases in vain, and short runs of words change nothing."""
    monkeypatch.setattr(collocations, "FILTER_BITS", 7)
    monkeypatch.setattr(collocations, "_SHIFT", 57)
    monkeypatch.setattr(collocations, "AT_ONCE", 100)
    rows = corpus(random.Random(10), 150)
    got = collocations.collocations(spark.createDataFrame(rows, DOCS))
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_ranks_end_at_the_top(spark):
    rows = [("en" if i % 3 else "de", f"p{i % 50:02} q", 40 + i % 5, 9, 9, 100, i % 4) for i in range(300)]
    df = spark.createDataFrame(rows, "lang string, phrase string, a long, l long, r long, n long, score long")
    got = sorted((r.lang, r.rank, r.score, r.a, r.phrase) for r in collocations.ranked(df, 30).collect())
    for lang in ("de", "en"):
        order = sorted(((-r[6], -r[2], r[1]) for r in rows if r[0] == lang))[:30]
        assert [(x[2], x[3], x[4]) for x in got if x[0] == lang] == [(-s, -a, p) for s, a, p in order]
        assert [x[1] for x in got if x[0] == lang] == list(range(1, 31))


def test_scores_past_64_bits(spark):
    rows = [("en", 0, "", 10**15), ("en", 1, "a", 9 * 10**13), ("en", 1, "b", 8 * 10**13), ("en", 2, "a b", 7 * 10**13)]
    df = spark.createDataFrame(rows, "lang string, size int, phrase string, n long")
    row = collocations.scored(df).first()
    assert (row.score, row.l, row.r, row.n) == (2_000_000 * 7 * 10**13 // (17 * 10**13), 9 * 10**13, 8 * 10**13, 10**15)


def test_edges(spark, edges, none):
    docs = edges.withColumn("lang", F.lit(None).cast("string"))
    got = {(r.lang, r.phrase, r.a, r.l, r.r, r.n) for r in collocations.collocations(docs).collect()}
    assert got == {("und", "word word word word", 199_997, 200_000, 199_998, 200_030)}
    assert collocations.collocations(none.withColumn("lang", F.lit("en"))).count() == 0
    assert collocations.collocations(docs.filter("doc_id < 5")).count() == 0
