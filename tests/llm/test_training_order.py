"""Round trips, the permutation, and resuming."""

import numpy as np
import pytest
from faultline.llm import queries
from faultline.llm import training_order as order


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 17, 64, 1000, 4097])
def test_permutation(size):
    got = order.permuted(np.arange(size), size, key=11)
    assert sorted(got) == list(range(size))
    if size > 100:
        assert not np.array_equal(got, np.arange(size)) and not np.array_equal(got, order.permuted(np.arange(size), size, key=12))


def decoded(rows):
    """{(doc_id): [token ids]} of the records."""
    out = {}
    for r in sorted(rows, key=lambda r: r.part):
        out.setdefault(r.doc_id, []).extend(np.frombuffer(r.record, np.uint16, r.tokens, order.HEADER_BYTES))
    return out


def test_query_round_trip(spark, sf, texts):
    rows = queries.queries()["op2_training_order"](spark, sf).collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    assert {len(r.record) for r in rows} == {order.stride()}
    assert all(r.shard == r.slot // order.SHARD and r.offset == r.slot % order.SHARD * order.stride() for r in rows)
    coding = order._encoding(order.VOCABULARY)
    ids = decoded(rows)
    assert ids.keys() == texts.keys()
    for i, text in texts.items():
        assert ids[i][-1] == order.END and coding.decode([int(x) for x in ids[i][:-1]]) == text


def test_order_depends_on_key_and_documents_alone(spark, docs):
    def slots(d, **args):
        return {(r.slot, r.doc_id, r.part) for r in order.training_order(d, **args).select("slot", "doc_id", "part").collect()}

    some = docs.select("doc_id", "text")
    one = slots(some.repartition(5))
    assert one == slots(some.coalesce(1)) and one != slots(some, key=1)


def test_shards_can_be_read_from_any_slot(spark, docs, tmp_path):
    ordered = order.training_order(docs, sequence=64, shard=100).cache()
    rows = sorted(ordered.collect(), key=lambda r: r.slot)
    for _ in range(2):  # a second run leaves the same files
        made = order.write_shards(ordered, str(tmp_path)).collect()
        assert sum(r.records for r in made) == len(rows) and len(made) == -(-len(rows) // 100)
    files = sorted(p.name for p in tmp_path.iterdir() if p.suffix == ".bin")
    assert len(files) == len(made) and {p.stat().st_size % order.stride(64) for p in tmp_path.glob("*.bin")} == {0}
    for start in (0, 1, 99, 100, 257, len(rows) - 1, len(rows)):
        got = list(order.read_from(str(tmp_path), start, 64, 100))
        assert [d for d, _ in got] == [r.doc_id for r in rows[start:]]
        assert all(len(ids) == r.tokens for (_, ids), r in zip(got, rows[start:]))


def test_edges(edges, none):
    rows = order.training_order(edges).collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    assert sum(r.doc_id is None for r in rows) == 1 and sum(r.doc_id == 1 for r in rows) == 2
    assert [r.tokens for r in rows if r.doc_id in (3, 4)] == [1, 1]
    assert order.training_order(none).count() == 0
