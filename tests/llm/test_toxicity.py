"""Held-out accuracy, chaining, and rows that say little."""

import random

import numpy as np
from faultline.llm import queries, toxicity
from pyspark.sql import functions as F

from .conftest import WORDS

BAD = ["grum", "vexo", "pludge"]


def corpus(spark, n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [rng.choice(WORDS) for _ in range(rng.randint(5, 80))]
        toxic, low = int(rng.random() < 0.3), int(rng.random() < 0.4)
        words += [rng.choice(BAD) + rng.choice(["", "en", "ist"]) for _ in range(2 * toxic)] + ["zzz"] * low
        rng.shuffle(words)
        rows.append((i, " ".join(words), low, toxic))
    return spark.createDataFrame(rows, "doc_id long, text string, low long, toxic long")


def test_held_out(spark):
    train, test = corpus(spark, 600, 1), corpus(spark, 400, 2)
    labels = train.select("doc_id", "low", "toxic")
    chain = toxicity.fit(train.select("doc_id", "text"), labels, ["low", "toxic"])
    assert len(chain.models[0].earlier) == 0 and len(chain.models[1].earlier) == 1
    rows = toxicity.score(test, chain).withColumnsRenamed({"low": "l", "toxic": "t"}).join(test, "doc_id").collect()
    assert np.mean([r.t == r.toxic for r in rows]) > 0.97 and np.mean([r.l == r.low for r in rows]) > 0.97
    kept = toxicity.accepted(test, chain, "toxic")
    assert kept.columns == test.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if not r.t}


def test_an_earlier_category_informs_a_later_one(spark):
    """The second label is that of the first: the chain passes it on as log-odds."""
    train = corpus(spark, 600, 3)
    labels = train.select("doc_id", "toxic", F.col("toxic").alias("again"))
    chain = toxicity.fit(train, labels, ["toxic", "again"])
    assert chain.models[1].earlier[0] > 0.1


def test_fit_against_plain_steps():
    """The weights minimise the penalised loss: a plain dense descent over fifty rows ends no lower."""
    rng = np.random.default_rng(6)
    x = (rng.random((50, 12)) < 0.3).astype(float)
    y = (x[:, 0] + x[:, 1] + 0.3 * rng.random(50) > 0.8).astype(float)
    row, col = np.nonzero(x)
    start = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=50))])
    dense = rng.normal(size=(50, 1))

    def loss(w):
        z = x @ w[:12] + dense @ w[12:13] + w[13]
        return np.mean(np.logaddexp(0, z) - y * z) + toxicity.L1 * np.abs(w[:13]).sum()

    wide, w = np.hstack([x, dense, np.ones((50, 1))]), np.zeros(14)
    for _ in range(20_000):
        step = w - 0.5 * wide.T @ (1 / (1 + np.exp(-wide @ w)) - y) / 50
        w = np.append(np.sign(step[:13]) * np.maximum(np.abs(step[:13]) - 0.5 * toxicity.L1, 0), step[13])
    found = toxicity._fit(start, col, dense, y, 12)
    assert loss(found) < loss(np.zeros(14)) and loss(found) - loss(w) < 0.02


def test_query(spark, sf, texts):
    rows = queries.queries()["op8_toxicity"](spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    assert all(0 <= r.p_toxic <= 1 and r.toxic in (0, 1) for r in rows)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    clean = [r for r in rows if labels.get(r.doc_id) == 0]
    assert sum(r.toxic for r in clean) <= 0.05 * len(clean)


def test_same_model_on_every_run(spark):
    train = corpus(spark, 200, 4)
    labels = train.select("doc_id", "low", "toxic")
    a, b = (toxicity.fit(train.repartition(n), labels.repartition(n), ["low", "toxic"], rows=100) for n in (1, 5))
    assert a == b


def test_little_to_learn_from(spark, edges, none):
    text = edges.select("doc_id", "text", "node")
    for labels in ([], [(1, 1, None)], [(1, 1, 0), (4, 1, 0), (None, 0, 1)], [(99, 1, 1)]):
        table = spark.createDataFrame(labels, "doc_id long, low long, toxic long")
        chain = toxicity.fit(text, table, ["low", "toxic"])
        assert toxicity.score(text, chain).count() == edges.count()
        assert toxicity.accepted(edges, chain, "toxic").count() == edges.count()
    assert toxicity.score(none, chain).count() == 0 and toxicity.accepted(none, chain, "toxic").count() == 0
