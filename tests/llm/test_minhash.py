"""MinHash near-duplicates against exact similarities of all pairs."""

import random

import duckdb
import numpy as np
import pytest
from faultline.llm import minhash, queries

from .conftest import WORDS


def brute_set(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)})
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if len(words) < 3:
        return {" ".join(words)} - {""}
    return {" ".join(words[i : i + 3]) for i in range(len(words) - 2)}


def brute(rows):
    """(doc_id, n_shingles, component_id) of rows with distinct ids."""
    sets = {i: brute_set(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                one, two = sorted((find(a), find(b)))
                root[two] = one
    return sorted((i, len(sets[i]), find(i)) for i in ids)


def found(rows):
    got = rows.collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in got)


def test_query_against_all_pairs_and_sql(spark, sf, texts):
    got = found(queries.queries()["op13_minhash"](spark, sf))
    assert got == brute(texts.items())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = con.execute(queries.OP13_SQL).fetchall()
    assert got == sorted(r[:3] for r in want)


def families(rng, groups, size, changed):
    """Texts of a hundred words; those of a group differ from its first in some words."""
    out = []
    for _ in range(groups):
        first = [rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(100)]
        for _ in range(size):
            words = list(first)
            for at in rng.sample(range(100), rng.randrange(changed)):
                words[at] = rng.choice(WORDS) + str(rng.randrange(40))
            out.append(" ".join(words))
    rng.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("heads", [1, 4])
def test_families_of_near_copies(spark, monkeypatch, heads):
    """Similarities around the threshold, so that buckets stay in parts through every step."""
    monkeypatch.setattr(minhash, "HEADS", heads)
    rows = families(random.Random(heads), 6, 30, 7)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert len({c for _, _, c in want}) > 6
    assert found(minhash.near_duplicates(docs)) == want


def test_threshold_is_exact(spark):
    """17 of 20 shingles shared is a link, 16 of 19 isn't."""
    base = [f"w{i}" for i in range(40)]
    rows = [(1, " ".join(base[:19])), (2, " ".join(base[:22])), (3, " ".join(base[3:21])), (4, " ".join(base[3:24]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(minhash.near_duplicates(docs)) == brute(rows)
    assert minhash.linked(np.arange(17), np.arange(20)) and not minhash.linked(np.arange(16), np.arange(19))
    assert not minhash.linked(np.arange(0), np.arange(0))


@pytest.mark.parametrize("how", [minhash.DOCUMENTS, minhash.NEAR])
def test_recall_of_bands_and_batches(how):
    """Pairs of sets at the threshold: nearly all share a band and none is pruned; pairs at 0.4 nearly all are."""
    rng = np.random.default_rng(4)

    def pair(shared, own):
        x = np.unique(rng.integers(0, 1 << 63, shared + 2 * own).astype(np.uint64))
        sides = x[: shared + own], np.concatenate([x[:shared], x[shared + own :]])
        return [minhash.signature(side, how.values) for side in sides]

    def passes(a, b):
        same = np.cumsum(a == b)
        ends = range(minhash.BATCH, how.values + 1, minhash.BATCH)
        return all(same[n - 1] >= minhash.least_matches(n, 256, how.percent) for n in ends)

    near = [pair(300, round(150 * (100 / how.percent - 1))) for _ in range(400)]
    met = sum((a == b).reshape(how.bands, how.rows).all(axis=1).any() for a, b in near)
    assert met >= 399 and all(passes(a, b) for a, b in near)
    far = [pair(200, 150) for _ in range(200)]
    assert sum(passes(a, b) for a, b in far) < 20


def test_edges(spark, edges, none):
    rows = minhash.near_duplicates(edges)
    assert rows.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    got = sorted(map(tuple, rows.collect()), key=str)
    want = [(1, 5, 1, True)] * 2 + [(2, 5, 1, False), (None, 6, None, False), (3, 0, 3, True), (4, 0, 4, True)]
    want += [(5, 0, 5, True), (6, 1, 6, True), (7, 1, 7, True)]
    assert got == sorted(want, key=str)
    assert minhash.near_duplicates(none).count() == 0


def test_copies_in_hundreds(spark):
    """A third of the rows are one text; its group is one node."""
    rows = [(i, "the same words over and over again in every row" if i % 3 else f"row {i} has its own words {i} {i + 1}") for i in range(600)]
    got = found(minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == brute(rows)


def test_rest_makes_no_pairs_that_cannot_be_linked(spark):
    """Edits of one text that are all less than the threshold alike share rare shingles and no link."""
    rng = random.Random(6)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(40):
        words = list(base)
        for at in rng.sample(range(0, 200, 5), 4):
            words[at] = f"x{i}y{at}"
        rows.append((7, i, i, 0, 40, " ".join(words)))
    apart = spark.createDataFrame(rows, "band long, node long, root long, main long, outside long, text string")
    pairs = minhash._rest(apart.drop("text"), apart.select("node", "text"), minhash.DOCUMENTS).collect()
    sets = {r[1]: minhash.shingle_set(r[5].encode()) for r in rows}
    linked = {(a, b) for a in sets for b in sets if a < b and minhash.linked(sets[a], sets[b])}
    assert linked <= {(r.a, r.b) for r in pairs} and len(pairs) <= len(linked) + 20


def test_beginnings_are_not_broadcast(spark):
    """Their file is a tenth of their size in memory, so Spark would send many of them to the driver."""
    rows = [(i, i, 0, " ".join(f"w{i * j}" for j in range(50))) for i in range(20)]
    apart = spark.createDataFrame(rows, "node long, root long, main long, text string")
    found = minhash._rest(apart.drop("text"), apart.select("node", "text"), minhash.NEAR)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_few_members_outside_the_largest_part_meet_no_more_heads(spark):
    """A bucket's own head has met all; the others are paired anew in crowded buckets only."""
    schema = "band long, node long, head long, root long, main long, outside long, bits long, size long"
    small = [(1, n, 10, n, 10, 4, 0, 20) for n in range(10, 15)]
    crowded = [(2, 100 + n, 100, 100 + n, 100, 999, 0, 20) for n in range(6)]
    got = minhash._with_heads(spark.createDataFrame(small + crowded, schema), minhash.DOCUMENTS).collect()
    assert got and all(100 < r.a < r.b for r in got)
