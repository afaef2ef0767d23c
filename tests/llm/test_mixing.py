"""Targets, balance and rounding against plain computations."""

import re
from collections import defaultdict

import pytest
from faultline.llm import mixing, queries
from pyspark.sql import functions as F


def brute_targets(sizes):
    """{source: target} of {source: size}."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, stopped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in stopped]
        rest = total - sum(3 * sizes[s] for s in stopped)
        level = rest / sum(weight[s] for s in free) if free else 0
        above = {s for s in free if weight[s] * level > 3 * sizes[s]}
        if not above:
            return {s: 3 * sizes[s] if s in stopped else weight[s] * level for s in order}
        stopped |= above


def check(rows, sources, texts=None):
    sizes = defaultdict(int)
    for r in rows:
        if texts:
            assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id] or ""))
        sizes[r.source] += r.size
    want, took = brute_targets(sizes), defaultdict(int)
    assert set(want) == sources
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        took[r.source] += r.taken
    return took, want


def test_query(spark, sf, docs, texts):
    query = queries.queries()["op9_mixing"]
    rows = query(spark, sf).collect()
    sources = {r.source for r in docs.select("source").distinct().collect()}
    source = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
    assert all(r.source == source[r.doc_id] for r in rows) and len(rows) == len(texts)
    took, want = check(rows, sources, texts)
    least = min(r.size for r in rows if r.size)
    assert all(abs(took[s] - want[s]) <= max(0.05 * want[s], 30 * least) for s in sources)
    assert sorted(map(tuple, query(spark, sf).collect())) == sorted(map(tuple, rows))


def test_reruns_agree_whatever_the_partitions(spark, docs):
    def taken(d):
        return sorted((r.doc_id, r.copies) for r in mixing.mix(d).collect())

    assert taken(docs.repartition(7)) == taken(docs.coalesce(1))


def test_sources_that_stop(spark):
    rows = [(i, "w " * (i % 9 + 1), "big") for i in range(400)] + [(1000 + i, "w", s) for i, s in enumerate("abc")] + [(2000, "w w", None)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    took, want = check(got, {"big", "a", "b", "c", None})
    assert want["a"] == 3 and took["a"] == 3 and took[None] == 6


def test_two_margins(spark):
    cells = [("a", "x", 100.0), ("a", "y", 300.0), ("b", "x", 50.0), ("b", "y", 70.0)]
    df = spark.createDataFrame(cells, "s string, l string, tokens double")
    s = spark.createDataFrame([("a", 300.0), ("b", 200.0)], "s string, target double")
    l = spark.createDataFrame([("x", 260.0), ("y", 240.0)], "l string, target double")  # noqa: E741
    got = mixing.balance(df, {"s": s, "l": l}, 5).withColumn("t", F.col("tokens") * F.col("rate"))
    assert {r.s: r.t for r in got.groupBy("s").agg(F.sum("t").alias("t")).collect()} == pytest.approx({"a": 300, "b": 200})
    assert {r.l: r.t for r in got.groupBy("l").agg(F.sum("t").alias("t")).collect()} == pytest.approx({"x": 260, "y": 240})
    r = {(r.s, r.l): r.rate for r in got.collect()}  # tilts multiply
    assert r["a", "x"] * r["b", "y"] == pytest.approx(r["a", "y"] * r["b", "x"])


def test_hot_cells_are_dealt_in_buckets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANKED_ROWS", 10)
    rows = [(i, "one two three", "abc"[i % 3]) for i in range(600)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    took, want = check(got, set("abc"))
    assert all(abs(took[s] - want[s]) <= 3 for s in "abc")


def test_edges(edges, none):
    got = mixing.mix(edges).collect()
    assert len(got) == edges.count()
    check(got, {"a", "b", "c", None})
    out = mixing.mixed(edges)
    assert out.columns == edges.columns and out.count() == sum(r.copies for r in got)
    assert mixing.mix(none).count() == 0 and mixing.mixed(none).count() == 0
    blank = edges.filter("doc_id in (3, 4, 5)")
    assert {(r.target, r.taken) for r in mixing.mix(blank).collect()} == {(0.0, 0)}
