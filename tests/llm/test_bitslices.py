"""Top-k by bit slices against plain inner products."""

import random

import duckdb
from faultline.llm import bitslices, queries
from pyspark.sql import functions as F


def brute(rows, chosen, k):
    out = set()
    for q, x in rows.items():
        if chosen(q):
            scores = [(-sum(a * b for a, b in zip(x, y)), i) for i, y in rows.items() if i != q and len(x) == len(y)]
            out |= {(q, n, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k], 1)}
    return out


def test_query_against_sql(spark, sf):
    got = queries.queries()["op1_bit_sliced_top_k"](spark, sf).select("query_id", "rank", "vec_id", "score").collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    assert sorted(map(tuple, got)) == sorted(con.execute(queries.OP1_SQL).fetchall())


def test_ties_signs_lengths_and_bad_vectors(spark):
    rng = random.Random(3)
    vectors = [(i, [rng.choice([-1.5, -0.25, 0.0, 0.5, 2.0]) for _ in range(5)]) for i in range(300)]
    vectors += [(300, [1.0, 2.0]), (302, [3.0, -1.0]), (304, []), (306, [7.0])]
    bad = [(400, None), (401, [1.0, None, 1.0, 1.0, 1.0]), (402, [float("nan")] * 5), (403, [float("inf")] * 5), (None, [1.0] * 5)]
    df = spark.createDataFrame(vectors + vectors[:20] + bad, "v long, e array<float>").withColumn("id", F.lit("x"))
    rows = bitslices.quantised(df, "v", "e")
    got = bitslices.top_k(rows, F.col("id") % 3 == 0, 7, block_rows=64, query_rows=16).collect()
    assert len(got) == len(set(got))
    ints = {i: [int(256 * x) for x in e] for i, e in vectors}
    assert {tuple(r) for r in got} == brute(ints, lambda q: q % 3 == 0, 7)


def test_huge_values_end_at_the_ends_of_a_long(spark):
    df = spark.createDataFrame([(0, [1e30, 1.0]), (1, [1e30, 1.0]), (2, [-1e30, 0.0])], "v long, e array<double>")
    got = bitslices.top_k(bitslices.quantised(df, "v", "e"), F.col("id") == 0, 5).orderBy("rank").collect()
    assert [(r.id, r.score) for r in got] == [(1, bitslices.MOST), (2, bitslices.LEAST)]


def test_empty(spark):
    df = spark.createDataFrame([], "v long, e array<float>")
    assert bitslices.top_k(bitslices.quantised(df, "v", "e"), F.lit(True), 5).count() == 0


def test_full_adders():
    rng = random.Random(1)
    query = [rng.randint(-300, 300) for _ in range(9)]
    values = [[rng.randint(0, 1000) for _ in range(9)] for _ in range(70)]
    slices = [[sum((v[d] >> j & 1) << r for r, v in enumerate(values)) for j in range(10)] for d in range(9)]
    total, offset = bitslices._scores(query, [5] * 9, slices, (1 << 70) - 1)
    got = [offset + sum((s >> r & 1) << j for j, s in enumerate(total)) for r in range(70)]
    assert got == [sum(q * (x + 5) for q, x in zip(query, v)) for v in values]
