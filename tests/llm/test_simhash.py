"""Fingerprints and components against brute force over all pairs."""

import random

import numpy as np
import xxhash
from faultline.llm import queries, simhash
from faultline.llm.components import components


def brute_print(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)})
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """{print: smallest id reachable} of (id, print) rows."""
    root = {p: p for _, p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a in list(root):
        for b in list(root):
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    least = {}
    for i, p in prints:
        if i is not None:
            least[find(p)] = min(least.get(find(p), i), i)
    return {p: least.get(find(p)) for _, p in prints}


def test_query_against_all_pairs(spark, sf, texts):
    rows = queries.queries()["op6_simhash"](spark, sf).collect()
    assert len(rows) == len(texts)
    prints = {r.doc_id: int(r.fingerprint, 16) for r in rows}
    assert prints == {i: brute_print(t) for i, t in texts.items()}
    want = brute_components(list(prints.items()))
    assert {r.doc_id: r.component_id for r in rows} == {i: want[p] for i, p in prints.items()}


def test_links_of_random_balls(spark):
    """Every pair within three bits, for fingerprints that crowd around some centres, in chains and in the sign bit."""
    rng = random.Random(7)
    prints = {0, 1, (1 << 64) - 1, 1 << 63}
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(25):
            prints.add(centre)
            for bit in rng.sample(range(64), rng.randint(1, 4)):
                prints.add(centre ^ (1 << bit))
                centre = centre ^ (1 << bit) if rng.random() < 0.3 else centre
    signed = [int(np.array(p, np.uint64).view(np.int64)) for p in prints]
    got = {(r.a, r.b) for r in simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()}
    mask = (1 << 64) - 1
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & mask).bit_count() <= 3}
    assert got == want


def test_replicas_are_not_broadcast(spark):
    """Spark sizes a table after ``explode`` as before it: 34 replicas a fingerprint would go to the driver."""
    found = simhash.links(spark.range(1000).withColumnRenamed("id", "fp"))
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_every_half_has_a_home_and_replicas_reach_it():
    flips = simhash._flips()
    assert [len(f) for f in flips] == [2] + [17] * 31


def test_edges(edges, none):
    rows = simhash.near_duplicates(edges).collect()
    assert len(rows) == edges.count()
    assert {r.fp for r in rows if r.doc_id in (3, 4, 5)} == {0}
    assert {r.component_id for r in rows if r.doc_id in (3, 4, 5)} == {3}
    assert {r.component_id for r in rows if r.doc_id in (1, 2)} == {1}
    kept = simhash.representatives(edges)
    assert kept.columns == edges.columns
    assert sorted((r.doc_id or -1, r.node) for r in kept.collect()) == [(-1, "kept"), (1, "kept"), (3, "kept"), (6, "kept"), (7, "kept")]
    assert simhash.near_duplicates(none).count() == 0 and simhash.representatives(none).count() == 0


def test_components_of_paths_stars_and_nothing(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(1000, i) for i in range(1001, 1050)]
    noise = [(5, 5), (None, 3), (7, 6)]
    got = {r.node: r.root for r in components(spark.createDataFrame(path + star + noise, "x long, y long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 1000 for i in range(1000, 1050)}
    assert components(spark.createDataFrame([], "x long, y long")).count() == 0


def test_near_copies_go(spark):
    """Texts of a Jaccard similarity of 0.8 over five words go, wherever their words are changed; others stay."""
    rng = random.Random(4)
    rows, want = [], []
    for n, changes in ((12, 0), (30, 1), (100, 1), (200, 1), (200, 3), (500, 5), (100, 12), (200, 30)):
        for _ in range(12):
            words = [f"w{rng.randrange(5000)}" for _ in range(n)]
            other = words.copy()
            for at in rng.sample(range(n), changes):
                other[at] = "changed"
            one, two = ({tuple(w[i : i + 5]) for i in range(n - 4)} for w in (words, other + ["more"] * (changes == 0)))
            i = len(rows)
            rows += [(i, " ".join(words)), (i + 1, " ".join(other).upper() + " more" * (changes == 0))]
            want += [i] if len(one & two) >= 0.8 * len(one | two) else [i, i + 1]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(r.doc_id for r in simhash.representatives(docs).collect())
    assert len(want) < 1.5 * len(rows) / 2 and got == want
