"""Lines that go against all pairs of distinct lines."""

import random
from collections import defaultdict

import numpy as np
from faultline.llm import lines, queries

K = lines.SHINGLE


def shingles(line):
    return {line[i : i + K] for i in range(max(1, len(line) - K + 1))}


def brute(docs):
    """{(doc, line number)} that go, of {doc: text}."""
    places = defaultdict(list)
    for doc, text in docs.items():
        for n, line in enumerate((text or "").split("\n")):
            if line.strip(" "):
                places[line].append((doc, n))
    distinct = list(places)
    sets, root = [shingles(x) for x in distinct], list(range(len(distinct)))
    holders = defaultdict(list)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in enumerate(sets):
        shared = defaultdict(int)
        for x in s:
            for j in holders[x]:
                shared[j] += 1
            holders[x].append(i)
        for j, both in shared.items():
            if both >= lines.SIMILAR * (len(s) + len(sets[j]) - both):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i, line in enumerate(distinct):
        groups[find(i)] += places[line]
    return {p for g in groups.values() for p in g if p != min(g)}


def test_query(spark, sf, texts):
    rows = queries.queries()["op5_line_dedup"](spark, sf).collect()
    want = brute(texts)
    assert want and {(r.doc_id, r.line_no) for r in rows} == want


def test_near_copies_in_a_large_group(spark):
    """A group of many edited copies hangs together, whichever two are linked directly."""
    rng = random.Random(2)
    base = "".join(rng.choice("abcdefgh ijklmnop") for _ in range(160))
    rows = {}
    for i in range(150):
        line = list(base)
        for _ in range(i % 3):
            line[rng.randrange(160)] = rng.choice("xyz")
        rows[i] = "".join(line) + "\n" + "".join(rng.choice("abcdefghijklmnop ") for _ in range(40))
    df = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    got = {(r.doc_id, r.line_no) for r in lines.duplicates(df).collect()}
    want = brute(rows)
    assert got <= want and len(got) >= 0.99 * len(want)


def test_pairs_apart_that_cannot_be_similar_are_not_made(spark, monkeypatch):
    """Sixty edits of one line, all two thirds alike: they share buckets and no link."""
    rng, made, similar = random.Random(4), [], lines._similar
    base = [rng.choice("abcdefghijklmnop ") for _ in range(300)]
    rows = []
    for i in range(60):
        line = list(base)
        for at in rng.sample(range(0, 300, 10), 5):
            line[at] = rng.choice("0123456789")
        rows.append((i, "".join(line)))

    def counted(pairs, *rest):
        made.append(pairs.count())
        return similar(pairs, *rest)

    monkeypatch.setattr(lines, "_similar", counted)
    assert lines.duplicates(spark.createDataFrame(rows, "doc_id long, text string")).count() == len(brute(dict(rows)))
    assert made[1] < 60


def test_parities_never_differ_in_more_than_the_sets():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for n in (1, 40, 3000, *[60] * 300)]
    marks = lines.parities(np.concatenate(sets), np.array([len(s) for s in sets]))
    bits = np.unpackbits(np.ascontiguousarray(marks).view(np.uint8), axis=1).astype(int)
    for i in range(len(sets) - 1):
        differ = len(np.setxor1d(sets[i], sets[i + 1]))
        assert 0 < (bits[i] ^ bits[i + 1]).sum() <= differ
    half = lines.parities(np.concatenate([sets[2], sets[2][:2990]]), np.array([len(sets[2]), 2990]))
    assert (np.unpackbits(half[:1].view(np.uint8)) != np.unpackbits(half[1:].view(np.uint8))).sum() <= 10


def test_recall_at_the_threshold(spark):
    """Pairs just above the threshold share a band nearly always."""
    rng = random.Random(9)
    pairs, texts = 0, {}
    for i in range(400):
        line = [rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(150)]
        other = line.copy()
        for at in rng.sample(range(0, 150, 30), 3):
            other[at] = "#"
        a, b = "".join(line), "".join(other)
        both = len(shingles(a) & shingles(b))
        if both / (len(shingles(a)) + len(shingles(b)) - both) >= lines.SIMILAR:
            texts[2 * i], texts[2 * i + 1] = a, b
            pairs += 1
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert pairs > 200 and lines.duplicates(df).count() >= 0.97 * pairs


def test_edges(edges, none, spark):
    gone = {(r.doc_id, r.line_no): r.kept_doc_id for r in lines.duplicates(edges).collect()}
    assert gone == {(2, 0): 1}  # rows that repeat a document share one decision, here to stay
    out = lines.deduplicated(edges)
    assert out.columns == edges.columns and out.count() == edges.count()
    assert lines.duplicates(none).count() == 0 and lines.deduplicated(none).count() == 0
    long = spark.createDataFrame([(1, "abc def ghi " * 30_000), (2, "abc def ghi " * 30_000 + "j")], "doc_id long, text string")
    assert lines.deduplicated(long).filter("text = ''").count() == 1
