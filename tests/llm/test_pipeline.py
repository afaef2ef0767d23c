"""The corpus job against plain versions of its stages, and the contract."""

import re
from collections import Counter

import __spark_entry__ as contract
import corpus_pipeline
import numpy as np
from faultline.llm import queries, training_order

from .test_mixing import brute_targets
from .test_simhash import brute_print
from .test_training_order import decoded

DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


def near_dedup(rows):
    """The rows left when fingerprints within three bits and texts alike by five words are one."""
    sets = [set(zip(*(r.text.encode().lower().split()[i:] for i in range(5)))) for r in rows]
    prints = [brute_print(r.text) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (p, x) in enumerate(zip(prints, sets)):
        for j in range(i):
            y = sets[j]
            if (p ^ prints[j]).bit_count() <= 3 or (x and y and 100 * len(x & y) >= 80 * len(x | y)):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        k = find(i)
        least[k] = min(least.get(k, r.doc_id), r.doc_id)
    return [r for i, r in enumerate(rows) if least[find(i)] == r.doc_id]


def test_stages_and_result(spark, sf, docs):
    seen = [docs]
    for _, step in corpus_pipeline.STAGES:
        seen.append(corpus_pipeline.stage(step(spark, seen[-1], sf)))
    assert all(d.columns == DOCUMENTS for d in seen[:-1])
    rows = [d.collect() for d in seen]
    chain = queries.toxicity_chain(spark, docs, sf).scorer()
    model = queries.toxicity_chain(spark, docs, sf).models[1]
    clean = [r for r in rows[0] if chain(r.text)[1] <= model.threshold]
    assert sorted(rows[1]) == sorted(clean) and len(clean) < len(rows[0])
    kept = near_dedup(clean)
    assert sorted(rows[2]) == sorted(kept) and len(kept) < len(clean)

    def words(text):
        return f" {' '.join(re.findall(r'[^\W_]+', text.lower()))} "

    items = [words(b.text) for b in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    without = [r for r in kept if not any(i in words(r.text) for i in items)]
    assert sorted(rows[3]) == sorted(without) and len(without) < len(kept)
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in without}
    sizes, took = Counter(), Counter()
    for r in without:
        sizes[r.source] += size[r.doc_id]
    for r in rows[4]:
        took[r.source] += size[r.doc_id]
    want = brute_targets(dict(sizes))
    assert max(Counter(rows[4]).values()) <= 3 and set(rows[4]) <= set(without)
    assert abs(sum(took.values()) - sum(want.values())) < 0.05 * sum(want.values())
    coding = training_order._encoding(training_order.VOCABULARY)
    times = Counter(r.doc_id for r in rows[4])
    text = {r.doc_id: r.text for r in without}
    slots = sorted(r.slot for r in rows[5])
    assert slots == list(range(len(slots)))
    firsts = Counter(r.doc_id for r in rows[5] if r.part == 0)
    assert firsts == times
    for i, ids in decoded([r for r in rows[5] if times[r.doc_id] == 1]).items():
        assert coding.decode([int(x) for x in np.array(ids)[:-1]]) == text[i]
    run = corpus_pipeline.run(spark, sf)
    assert Counter(r.doc_id for r in run.select("doc_id").collect()) == Counter(r.doc_id for r in rows[5])


def test_stages_take_edges(spark, sf, edges, none):
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, edges, sf).count() >= 0
        assert step(spark, none, sf).count() == 0


def test_registered():
    names = contract.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names and set(queries.oracle_sql()) <= set(contract.oracle_sql())
    assert len(corpus_pipeline.STAGES) == 5
