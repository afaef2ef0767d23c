"""MinHash near-duplicates with sequential Bayesian verification.

A document's set is its distinct word shingles; equal sets are one node from then
on. A node has some MinHash values, of which a byte each is kept. Nodes that agree in
all values of a band are candidates. Their signatures are compared a batch
after the other: after n values of which m agree, a pair is dropped once the posterior
chance that its similarity reaches the threshold, from an even prior, is below MISS. The
survivors are compared exactly, on their full sets.

Buckets may be large, so pairs are never spelled out within one. First the members of
a bucket are compared with one of them, its head, and what is linked is merged. Where
a bucket is still in parts, with CROWD members or more outside the largest, the other
members meet HEADS other heads of them.
What is apart after that are members without a link to any head: they are compared
with all other parts, as far as the sets share one of their rarest shingles, which
linked ones do for certain, and as the parities of their shingles (``lines.parities``)
leave a link possible. Few others do, so signatures are not asked again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_intdigest, xxh64_intdigest

from .common import positions, stage
from .components import components
from .lines import _among, may_link, parities, parity_columns


@dataclass(frozen=True)
class Likeness:
    """Sets of ``shingle`` words are linked if ``percent`` % of their union is shared.

    ``bands`` of ``rows`` values each find the candidates.
    """

    shingle: int
    percent: int
    rows: int
    bands: int

    @property
    def values(self) -> int:
        return self.rows * self.bands


#: Of the pairs at ``percent`` exactly, 0.008 % share no band.
DOCUMENTS = Likeness(3, 85, 5, 16)
#: The same for near copies as other stages take them: 0.007 %.
NEAR = Likeness(5, 80, 5, 24)
#: Signature values compared together, and the chance of a link below which a pair is dropped.
BATCH, MISS = 20, 1e-6
#: Heads that the members of a bucket still in parts are compared with.
HEADS = 4
#: Members outside a bucket's largest part from which on that is worth it; fewer are left to the rare shingles.
CROWD = 32
#: Values of which one bit each makes the sketch.
SKETCH = 64
#: Bits of the table of counts that says how rare a shingle is.
COUNT_BITS = 20
#: Steps of that table to a doubling of the count, and longs that hold the parities of a set's shingles.
FINE, PARITY = 2048, 8
#: Shingles hashed for all values at once.
BLOCK = 2048
#: Sets that a verifying task remembers.
REMEMBERED = 256

_SEEDS = np.array([xxh64_intdigest(f"minhash seed {i}") for i in range(128)], np.uint64)
_FACTORS = np.array([xxh64_intdigest(f"minhash factor {i}") | 1 for i in range(128)], np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: bytes | None, shingle: int = DOCUMENTS.shingle) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; fewer words are one shingle, none give none.

    A-Z are lower-cased; bytes.split cuts at space and \\t to \\r, nothing else.
    """
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    known = {w: xxh64_intdigest(w) for w in set(words)}
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    size = min(shingle, len(words))
    n = len(words) - size + 1
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = (out ^ (out >> np.uint64(29)) ^ hashes[k : k + n]) * _MIX
    return np.unique(out ^ (out >> np.uint64(32)))


def signature(hashes: np.ndarray, values: int = DOCUMENTS.values) -> np.ndarray:
    """The top byte of each MinHash value of a set that isn't empty."""
    least = np.full(values, ~np.uint64(0))
    for at in range(0, len(hashes), BLOCK):
        part = (hashes[at : at + BLOCK, None] ^ _SEEDS[:values]) * _FACTORS[:values]
        least = np.minimum(least, part.min(axis=0))
    # the least values are all small at the top: mixed once more, any byte is even
    return ((least * _MIX) >> np.uint64(56)).astype(np.uint8)


@lru_cache(16)
def least_matches(n: int, values: int, percent: int = DOCUMENTS.percent, miss: float = MISS) -> int:
    """Matches among ``n`` signature values of ``values`` kinds below which a pair is dropped.

    The similarity's prior is even on [0, 1]; different sets agree in a value by
    chance once in ``values``.
    """
    at = (np.arange(20_000) + 0.5) / 20_000
    p = at + (1 - at) / values
    for m in range(n + 1):
        like = m * np.log(p) + (n - m) * np.log1p(-p)
        like = np.exp(like - like.max())
        if like[at >= percent / 100].sum() >= miss * like.sum():
            return m
    return n


def _signing(how: Likeness) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, ones, twos, sketches, signs = [], [], [], [], []
            for text in b.column("text").cast(pa.binary()):
                s = shingle_set(text.as_py(), how.shingle)
                sizes.append(len(s))
                if not len(s):
                    for out in (ones, twos, sketches, signs):
                        out.append(None)
                    continue
                key = xxh3_128_intdigest(s.tobytes())
                sign = signature(s, how.values)
                for out, x in ((ones, key >> 64), (twos, key & (1 << 64) - 1)):
                    out.append(x - (1 << 64) if x >> 63 else x)
                sketches.append(int(np.packbits(sign[:SKETCH] & 1).view(np.int64)[0]))
                signs.append(sign.tobytes())
            arrays = [pa.array(x, pa.int64()) for x in (sizes, ones, twos, sketches)] + [pa.array(signs, pa.binary())]
            names = ["n_shingles", "one", "two", "bits", "sign"]
            keys = ["doc_id", "t1", "t2"]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keys), *arrays], [*keys, *names])

    return run


def _text_keys(docs: DataFrame) -> DataFrame:
    """(doc_id, t1, t2, text): a text is known by two hashes."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text).alias("t1"),
        F.xxhash64(F.lit(1), text).alias("t2"),
        F.col("text"),
    )


def signatures(docs: DataFrame, how: Likeness = DOCUMENTS) -> DataFrame:
    """One row per row of ``docs``: its set's size, its 128-bit key, sketch and signature."""
    schema = "doc_id long, t1 long, t2 long, n_shingles long, one long, two long, bits long, sign binary"
    return _text_keys(docs).mapInArrow(_signing(how), schema)


def _banding(how: Likeness) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            signs = np.frombuffer(b"".join(b.column("sign").to_pylist()), np.uint8).reshape(len(b), how.bands, how.rows)
            keys = np.tile(np.arange(1, how.bands + 1, dtype=np.uint64) * _MIX, (len(b), 1))
            for k in range(how.rows):
                keys = (keys ^ (keys >> np.uint64(31)) ^ signs[:, :, k]) * _MIX
            keys ^= keys >> np.uint64(32)
            nodes = np.repeat(b.column("node").to_numpy(), how.bands)
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(keys.ravel().view(np.int64))], ["node", "band"])

    return run


def _buckets(nodes: DataFrame, how: Likeness) -> DataFrame:
    """(node, band, head) of all buckets with two members or more; the head is the least."""
    keys = stage(nodes.select("node", "sign").mapInArrow(_banding(how), "node long, band long"))
    full = keys.groupBy("band").agg(F.min("node").alias("head"), F.max("node").alias("_last")).filter("head < _last")
    return keys.join(full.select("band", "head"), "band")


def _likely(how: Likeness) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            left = np.arange(len(b))
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(len(b), how.values) for c in ("x", "y"))
            same = np.zeros(len(b), np.int64)
            for at in range(0, how.values, BATCH):
                same = same + (x[left, at : at + BATCH] == y[left, at : at + BATCH]).sum(axis=1)
                likely = same >= least_matches(min(at + BATCH, how.values), 256, how.percent)
                left, same = left[likely], same[likely]
            yield b.select(["a", "b"]).take(pa.array(left))

    return run


def linked(x: np.ndarray, y: np.ndarray, percent: int = DOCUMENTS.percent) -> bool:
    """Whether two sets of shingles share enough of their union; empty ones never do."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(x) + len(y) - both)


def _verifying(how: Likeness) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = lru_cache(REMEMBERED)(lambda text: shingle_set(text, how.shingle))
        for b in batches:
            texts = (b.column(c).cast(pa.binary()) for c in ("x", "y"))
            same = [linked(hashes(x.as_py()), hashes(y.as_py()), how.percent) for x, y in zip(*texts)]
            yield b.select(["a", "b"]).filter(pa.array(same, pa.bool_()))

    return run


def _ends(df: DataFrame, *columns: str) -> list[DataFrame]:
    """``df`` by the first and by the second end of a pair, with ``columns`` as struct x and y."""
    return [df.select(F.col("node").alias(k), F.struct(*columns).alias(v)) for k, v in (("a", "x"), ("b", "y"))]


def _sized(how: Likeness) -> Column:
    """Whether the smaller of x and y is large enough for a link: no more than it can be shared."""
    sizes = F.col("x.size"), F.col("y.size")
    return 100 * F.least(*sizes) >= how.percent * F.greatest(*sizes)


def _confirmed(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, how: Likeness) -> DataFrame:
    """The links among the candidate pairs (a, b): sizes, signatures batch by batch, then whole sets."""
    one, two = _ends(nodes, "size", "sign")
    met = pairs.join(one, "a").join(two, "b").filter(_sized(how))
    met = met.select("a", "b", F.col("x.sign").alias("x"), F.col("y.sign").alias("y"))
    likely = met.mapInArrow(_likely(how), "a long, b long")
    return _verified(stage(likely), texts, how)


def _verified(pairs: DataFrame, texts: DataFrame, how: Likeness) -> DataFrame:
    """The links among the candidate pairs (a, b) by whole sets."""
    one, two = _ends(texts, "text")
    met = pairs.join(one, "a").join(two, "b").select("a", "b", F.col("x.text").alias("x"), F.col("y.text").alias("y"))
    return stage(met.mapInArrow(_verifying(how), "a long, b long"))


def _apart(members: DataFrame, roots: DataFrame) -> DataFrame:
    """``members`` (node, band, ...) of buckets in more than one part, with the node's and the largest part's root,
    and how many members are outside that part."""
    rooted = stage(members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    parts = rooted.groupBy("band", "root").agg(F.count(F.lit(1)).alias("n"))
    top = F.max(F.struct("n", "root")).alias("top")
    mixed = parts.groupBy("band").agg(top, F.sum("n").alias("all")).filter("`all` > top.n")
    return rooted.join(mixed.selectExpr("band", "top.root AS main", "`all` - top.n AS outside"), "band")


def _pairs(met: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) of the columns x.node and y.node."""
    ends = F.col("x.node"), F.col("y.node")
    return met.select(F.least(*ends).alias("a"), F.greatest(*ends).alias("b")).distinct()


def _agree(how: Likeness) -> Column:
    """Whether a link of x and y is likely enough by their sketches, the first batch of all."""
    return SKETCH - F.bit_count(F.col("x.bits").bitwiseXOR(F.col("y.bits"))) >= least_matches(SKETCH, 2, how.percent)


def _with_heads(apart: DataFrame, how: Likeness) -> DataFrame:
    """Pairs of the members of a crowded bucket with HEADS of them, as far as they are in other parts.

    The bucket's own head has met all of them.
    """
    apart = apart.filter((F.col("node") != F.col("head")) & (F.col("outside") >= CROWD))
    firsts = [F.min(F.struct(F.xxhash64("node", F.lit(i)).alias("_h"), "node", "root", "bits", "size")) for i in range(HEADS)]
    heads = apart.groupBy("band").agg(F.array(*firsts).alias("heads"))
    heads = heads.select("band", F.explode(F.array_distinct("heads")).alias("y"))
    other = F.col("x.root") != F.col("y.root")
    return _pairs(apart.alias("x").join(heads, "band").filter(other & _sized(how) & _agree(how)))


def _counting(how: Likeness) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNT_BITS, np.int64)
        for b in batches:
            for text in b.column("text").cast(pa.binary()):
                np.add.at(total, shingle_set(text.as_py(), how.shingle) >> np.uint64(64 - COUNT_BITS), 1)
        slots = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(slots.astype(np.int32)), pa.array(total[slots])], ["slot", "n"])

    return run


def _beginning(how: Likeness, rarity: np.ndarray) -> Callable:
    """The shingles of a set up to which two linked ones must have met, the rarest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for node, root, minor, text in zip(*(b.column(c) for c in ("node", "root", "minor", "text"))):
                s = shingle_set(text.as_py().encode("utf-8", "replace"), how.shingle)
                s = s[np.argsort(rarity[s >> np.uint64(64 - COUNT_BITS)], kind="stable")]
                first = s[: len(s) - -(-how.percent * len(s) // 100) + 1].view(np.int64)
                n = len(first)
                each = [pa.array(first), *(pa.array([x.as_py()] * n) for x in (node, root, minor))]
                marks = [pa.array(np.full(n, x)) for x in parities(s, np.array([len(s)]), PARITY)[0]]
                yield pa.RecordBatch.from_arrays([*each, pa.array(np.arange(n)), pa.array(np.full(n, len(s))), *marks], _BEGIN)

    return run


_BEGIN = ["token", "node", "root", "minor", "place", "size", *parity_columns(PARITY)]


def _rest(apart: DataFrame, texts: DataFrame, how: Likeness) -> DataFrame:
    """Pairs of members outside a bucket's largest part with all of other parts that may be linked; none is left out.

    In an order of all shingles, the same for all sets, the first one that two sets
    share has at most the rest of either set behind it. So linked sets meet near
    their beginnings; with rare shingles first, few others do. How rare a shingle is
    comes from counts in a table of fixed size, which costs pairs where it errs, not links.
    Pairs whose parities say that they differ in more shingles than a link can are not made.
    A file of beginnings is a small part of their size in memory, as all rows of a set are
    alike but for the token; so they are not broadcast by it.
    """
    members = apart.groupBy("node", "root").agg(F.max(F.col("root") != F.col("main")).alias("minor"))
    members = stage(members.join(texts, "node"))
    counted = members.select("text").mapInArrow(_counting(how), "slot int, n long")
    counted = counted.groupBy("slot").agg(F.sum("n").alias("n")).toArrow()  # 2 ** COUNT_BITS rows at most
    rarity = np.zeros(1 << COUNT_BITS, np.uint16)
    rarity[counted.column("slot").to_numpy()] = np.minimum(FINE * np.log2(counted.column("n").to_numpy()), (1 << 16) - 1)
    schema = ", ".join(f"{c} {'boolean' if c == 'minor' else 'long'}" for c in _BEGIN)
    begins = stage(members.select("node", "root", "minor", "text").mapInArrow(_beginning(how, rarity), schema))
    x, y = begins.filter("minor").alias("x"), begins.alias("y")
    once = ~F.col("y.minor") | (F.col("x.node") < F.col("y.node"))
    behind = F.least(F.col("x.size") - F.col("x.place"), F.col("y.size") - F.col("y.place"))
    enough = behind * (100 + how.percent) >= how.percent * (F.col("x.size") + F.col("y.size"))
    apart = (F.col("x.token") == F.col("y.token")) & (F.col("x.root") != F.col("y.root"))
    return _pairs(x.join(y.hint("merge"), apart & once & enough & may_link(how.percent, PARITY)))


def links(docs: DataFrame, nodes: DataFrame, how: Likeness = DOCUMENTS) -> DataFrame:
    """(a, b): links between nodes, enough of them to connect all that are linked.

    ``nodes`` is (node, t1, t2, size, bits, sign), one row per distinct set.
    """
    buckets = stage(_buckets(nodes, how))
    need = nodes.join(buckets.select("node").distinct(), "node", "left_semi").select("node", "t1", "t2")
    whole = _text_keys(docs).withColumnRenamed("t1", "node")
    whole = _among(whole, need.select(F.col("t1").alias("node")).distinct()).withColumnRenamed("node", "t1")
    texts = stage(whole.join(need, ["t1", "t2"]).select("node", "text").dropDuplicates(["node"]))
    stars = buckets.filter("head < node").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
    found = _confirmed(stars, nodes, texts, how)
    apart = _apart(buckets, components(found)).drop("root", "main", "outside")
    apart = stage(apart.join(nodes.select("node", "bits", "size"), "node"))
    found = found.unionAll(_confirmed(_with_heads(_apart(apart, components(found)), how), nodes, texts, how))
    rest = _rest(_apart(apart, components(found)), texts, how)
    return found.unionAll(_verified(rest, texts, how))


def classes(docs: DataFrame, how: Likeness = DOCUMENTS) -> tuple[DataFrame, DataFrame]:
    """The rows' keys (doc_id, t1, n_shingles, one, two), and (one, two, root, least) of each distinct set.

    root is the same for all sets of a component, least its smallest doc_id. Rows
    without words have no set.
    """
    rows = stage(signatures(docs, how))
    key = ["one", "two"]
    full = rows.filter("n_shingles > 0")
    one_row = F.min(F.struct("t1", "t2", F.col("n_shingles").alias("size"), "bits", "sign")).alias("row")
    sets = full.groupBy(*key).agg(one_row, F.min("doc_id").alias("id"))
    nodes = stage(positions(sets, *map(F.col, key)).select(F.col("position").alias("node"), "id", *key, "row.*"))
    rooted = nodes.select("node", "id", *key).join(components(links(docs, nodes, how)), "node", "left")
    rooted = stage(rooted.withColumn("root", F.coalesce("root", "node")))
    least = rooted.groupBy("root").agg(F.min("id").alias("least"))
    return rows.select("doc_id", "t1", "n_shingles", *key), rooted.join(least, "root").select(*key, "root", "least")


def near_duplicates(docs: DataFrame, how: Likeness = DOCUMENTS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``.

    component_id is the smallest doc_id reachable over links, the row's own
    included; kept says that it is the row's own. Defined cases: a null or empty
    text, or one of white space alone, has an empty set and is linked with nothing;
    rows that repeat an id are rows of their own; a null doc_id never becomes a
    component_id unless the component has no other, and is not kept; no documents
    give no rows. Only doc_id and text are read.
    """
    rows, sets = classes(docs, how)
    found = rows.join(sets, ["one", "two"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id"))
    kept = F.coalesce(F.col("doc_id") == component, F.lit(False))
    return found.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"))


def near_copies(docs: DataFrame, how: Likeness = NEAR) -> DataFrame:
    """(a, b): links between text hashes that connect all texts as alike as ``how`` says."""
    rows, sets = classes(docs, how)
    texts = rows.select("t1", "one", "two").distinct().join(sets, ["one", "two"]).select("t1", "root")
    hubs = texts.groupBy("root").agg(F.min("t1").alias("a"))
    return texts.join(hubs, "root").select("a", F.col("t1").alias("b"))
