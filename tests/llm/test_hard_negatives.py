"""Hard negatives against plain inner products of all pairs."""

import random
from math import floor

import duckdb
import numpy as np
import pytest
from faultline.llm import hard_negatives, queries
from pyspark.sql import functions as F

VECTORS = "vec_id long, embedding array<double>, label int"


def brute(rows, chosen, k=5):
    """Of (id, vector, label) rows with distinct ids: the contract, pair by pair."""
    rows = [(i, [floor(256 * x) for x in v], l) for i, v, l in rows]
    out = []
    for a, x, label in rows:
        if not chosen(a):
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y)), i, l) for i, y, l in rows if i != a and len(y) == len(x))
        positives = [(i, -s) for s, i, l in scored if l == label][:k]
        for place, (p, ps) in enumerate(positives, 1):
            fit = [(i, -s) for s, i, l in scored if l != label and 80 * ps <= -100 * s <= 100 * ps][:k]
            out += [(a, p, place, n, i, ps, s) for n, (i, s) in enumerate(fit, 1)]
    return sorted(out)


def found(spark, rows, chosen, **how):
    df = spark.createDataFrame(rows, VECTORS)
    usable = hard_negatives.usable(df, "vec_id", "embedding", F.col("label"))
    return sorted(map(tuple, hard_negatives.mine(usable, chosen, **how).collect()))


def test_query_against_sql(spark, sf):
    rows = queries.queries()["op12_hard_negatives"](spark, sf)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    result = con.execute(queries.OP12_SQL)
    assert rows.columns == [d[0] for d in result.description]
    want = sorted(result.fetchall())
    assert want and sorted(map(tuple, rows.collect())) == want


@pytest.mark.parametrize("spread", [0.2, 2.0])
def test_clusters_ties_and_small_blocks(spark, spread):
    """Vectors around a few centres, with many equal scores, over several blocks and groups."""
    rng = random.Random(5)
    centres = [[rng.choice([-1.0, -0.5, 0.5, 1.0]) for _ in range(9)] for _ in range(6)]
    rows = []
    for i in range(400):
        c = centres[i % 6]
        rows.append((i, [x + spread * rng.choice([-0.25, 0.0, 0.25]) for x in c], i * 7 // 6 % 4))
    got = found(spark, rows, F.col("id") % 4 == 0, block_rows=64, group_rows=20)
    assert got == brute(rows, lambda i: i % 4 == 0)


def test_lengths_zeros_large_values_and_bad_vectors(spark):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(3)], i % 3) for i in range(60)]
    rows += [(100 + i, [0.0, 0.0, 0.0], i % 2) for i in range(6)]
    rows += [(200, [1.0], 0), (201, [2.0], 0), (202, [1.75], 1), (203, [], 0), (204, [], 0), (205, [], 1)]
    good = list(rows)
    rows += [(300, None, 1), (301, [1.0, None, 0.0], 1), (302, [float("nan")] * 3, 1), (303, [float("inf")] * 3, 1)]
    rows += [(304, [9.0] * 3, None), (None, [9.0] * 3, 1)]
    assert found(spark, rows, F.lit(True)) == brute(good, lambda i: True)
    # scores near 2 ** 60 are exact, those past a long end at its ends
    huge = [(i, [4.0e5 * (i + 1), 3.0e5], i % 2) for i in range(8)]
    assert found(spark, huge, F.lit(True)) == brute(huge, lambda i: True)
    past = [(0, [1e30], 0), (1, [1e30], 0), (2, [1e30], 1)]
    assert found(spark, past, F.lit(True)) == [(0, 1, 1, 1, 2, 2**63 - 1, 2**63 - 1), (1, 0, 1, 1, 2, 2**63 - 1, 2**63 - 1)]


def test_repeated_rows_and_ids(spark):
    """Equal rows count as often as they are there, and rows that share an id alone stay apart."""
    rows = [(1, [1.0, 0.0], 0)] * 2 + [(1, [0.5, 0.5], 0), (2, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (2, [0.9, 0.0], 1)]
    got = found(spark, rows, F.col("label") == 0)
    same, other = 256 * 256, 256 * 128
    first = [(1, 1, 1, n, 2, same, same) for n in (1, 2)] + [(1, 1, 1, 3, 2, same, 256 * 230)]
    # each of the two equal anchors has the other and the third row as positives; the third row has both
    assert [r for r in got if r[5] == same] == sorted(first * 2)
    assert {r[5] for r in got} == {same, other} and len([r for r in got if r[5] == other]) == 2 * 0 + 2 * 3


def test_intervals_hold_every_score():
    rng = np.random.default_rng(2)
    values = np.rint(rng.normal(size=(300, 24)) * rng.choice([1, 50, 3000], (300, 1))).astype(np.int64)
    codes, along, norms = hard_negatives.encode(values)
    packed = {
        "ids": np.arange(300), "labels": np.zeros(300), "copies": np.ones(300), "values": values.tobytes(),
        "codes": codes.tobytes(), "along": along.tobytes(), "norms": norms.tobytes(),
    }
    block = hard_negatives.Block(packed, 24)
    turns = [hard_negatives.rotation(24, level) for level in range(hard_negatives.LEVELS)]
    widths = []
    for q in values[:40]:
        anchor, exact = hard_negatives.Anchor(q, turns), values @ q

        def wanted(rows, low, high):
            assert (low <= exact[rows]).all() and (exact[rows] <= high).all()
            widths.append((high - low).mean())
            return np.ones(len(rows), bool)

        assert len(hard_negatives.intervals(anchor, block, wanted, np.arange(300))) == 300
    each = np.array(widths).reshape(40, -1)
    assert (each[:, 1:] < 0.8 * each[:, :-1]).all()  # every code narrows them


def test_edges(spark):
    none = spark.createDataFrame([], VECTORS)
    usable = hard_negatives.usable(none, "vec_id", "embedding", F.col("label"))
    assert hard_negatives.mine(usable, F.lit(True)).count() == 0
    extra = spark.createDataFrame([(i, [1.0, float(i)], i % 2) for i in range(6)], VECTORS)
    for name in ("id", "values", "dims", "copies", "block", "part", "score", "rank"):
        extra = extra.withColumn(name, F.lit("kept"))
    usable = hard_negatives.usable(extra, "vec_id", "embedding", F.col("label"))
    assert hard_negatives.mine(usable, F.col("id") < 0).count() == 0
    assert hard_negatives.mine(usable, F.lit(True)).count() > 0
