"""SimHash near-duplicates by anchor points of a covering code.

Two fingerprints of 64 bits that differ in at most three bits agree, up to one
bit, in one of their halves. The anchors of a half are the words of the perfect
[31, 26] Hamming code with the 32nd bit left free: every half lies within one bit
of an anchor (the covering radius). A fingerprint has its home at the nearest
anchor and is replicated to every anchor within radius plus threshold, that is
within two bits; whoever lies within one bit of it in that half has its home at
one of them. So a comparison of homes with replicas, anchor by anchor, meets
every link, and the full 64 bits decide. A fingerprint has at most 17 replicas a
half, whatever the input.

Three bits are few: of texts with a Jaccard similarity of 0.8 most are further apart.
``representatives`` therefore also links texts by the words they share, as ``minhash``
finds them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from . import minhash
from .common import fresh, stage, text_hash
from .components import components

SHINGLE = 3
THRESHOLD = 3
HALF = 32
CODE_BITS = 31
#: Shingles counted at once, so that a very long text takes bounded memory.
BLOCK = 65_536


def fingerprint(text: bytes | None) -> int:
    """Signed 64-bit SimHash of the text's word shingles; 0 without words.

    A-Z are lower-cased; bytes.split cuts at space and \\t to \\r, nothing else.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - SHINGLE + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        end = min(n, at + BLOCK)
        shingles = zip(*(words[at + i : end + i] for i in range(SHINGLE))) if len(words) >= SHINGLE else [words]
        hashes = np.array([xxh64_intdigest(b" ".join(s), 42) for s in shingles], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.int64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        hashes = pa.array([fingerprint(t.as_py()) for t in texts], pa.int64())
        keys = [batch.column(c) for c in ("doc_id", "text_hash")]
        yield pa.RecordBatch.from_arrays([*keys, hashes], ["doc_id", "text_hash", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fp), one row per row of ``docs``."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("text_hash"), "text")
    return narrow.mapInArrow(_fingerprints, "doc_id long, text_hash long, fp long")


def _flips() -> list[list[int]]:
    """By syndrome: which bits to flip to reach each anchor within two bits; home first."""
    free = 1 << CODE_BITS
    table = [[0, free]]
    for syndrome in range(1, HALF):
        home = 1 << (syndrome - 1)
        pairs = [
            1 << (i - 1) | 1 << ((i ^ syndrome) - 1) for i in range(1, HALF) if i < (i ^ syndrome) and i != syndrome
        ]
        table.append([home, home | free, *pairs])
    return table


def _syndrome(half: Column) -> Column:
    """XOR of the numbers, from 1, of the set bits among the lower 31."""
    out = F.lit(0)
    for j in range(5):
        mask = sum(1 << (i - 1) for i in range(1, HALF) if i >> j & 1)
        odd = F.bit_count(half.bitwiseAND(F.lit(mask).cast("long"))) % 2
        out = out + odd * F.lit(1 << j)
    return out.cast("int")


def _anchors(prints: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Homes and replicas: (fp, half, anchor), for each half of each fingerprint."""
    low = F.col("fp").bitwiseAND(F.lit((1 << HALF) - 1).cast("long"))
    halves = prints.select(
        "fp", F.posexplode(F.array(low, F.shiftrightunsigned("fp", HALF))).alias("half", "bits")
    )
    flips = F.array(*(F.array(*(F.lit(m).cast("long") for m in masks)) for masks in _flips()))
    halves = halves.withColumn("flips", F.get(flips, _syndrome(F.col("bits"))))
    home = halves.select("fp", "half", F.col("bits").bitwiseXOR(F.get("flips", F.lit(0))).alias("anchor"))
    near = halves.select("fp", "half", "bits", F.explode("flips").alias("flip"))
    return home, near.select("fp", "half", F.col("bits").bitwiseXOR(F.col("flip")).alias("anchor"))


def links(prints: DataFrame) -> DataFrame:
    """(a, b) with a < b for all distinct fingerprints at most three bits apart.

    ``prints`` has distinct values in column ``fp``. Groups of copies are one
    fingerprint here; a large anchor is split by the join's skew handling. Spark sizes
    homes and replicas as if ``explode`` made one row of each, and would broadcast them.
    """
    home, near = _anchors(prints)
    meet = home.alias("x").join(
        near.alias("y").hint("merge"),
        (F.col("x.half") == F.col("y.half"))
        & (F.col("x.anchor") == F.col("y.anchor"))
        & (F.col("x.fp") != F.col("y.fp"))
        & (F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= THRESHOLD),
    )
    ends = F.col("x.fp"), F.col("y.fp")
    return meet.select(F.least(*ends).alias("a"), F.greatest(*ends).alias("b")).distinct()


def classes(prints: DataFrame) -> DataFrame:
    """(fp, component_id) for each distinct fingerprint of (doc_id, fp) rows."""
    reps = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    linked = components(links(reps.select("fp"))).withColumnRenamed("node", "fp")
    rooted = reps.join(linked, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    return rooted.join(least, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, fp, component_id.

    component_id is the smallest doc_id reachable over links, the row's own
    included. Defined cases: a null or empty text, or one of white space alone,
    has fingerprint 0 and is linked like any other; a null doc_id never becomes a
    component_id unless the component has no other; rows that repeat an id are
    rows of their own; no documents give no rows. Only doc_id and text are read.
    """
    prints = stage(fingerprints(docs))
    return prints.join(classes(prints), "fp")


def representatives(docs: DataFrame, how: minhash.Likeness = minhash.NEAR) -> DataFrame:
    """``docs`` with one row left of each component: that of the smallest doc_id.

    Components hang together by fingerprints, as in ``near_duplicates``, and by texts
    that are as alike as ``how`` says: five words, a Jaccard similarity of 0.8.
    Among rows with the smallest id the smallest text hash stays, and of equal rows
    one; null ids come last. All columns of ``docs`` are kept as they are.
    """
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    prints = stage(fingerprints(docs))
    firsts = stage(prints.groupBy("text_hash", "fp").agg(F.min(order).alias("k")))
    roots = components(links(prints.select("fp").distinct())).withColumnRenamed("node", "fp")
    hung = firsts.join(roots, "fp", "left").select(F.coalesce("root", "fp").alias("root"), "text_hash")
    hubs = hung.groupBy("root").agg(F.min("text_hash").alias("a"))
    by_print = hung.join(hubs, "root").select("a", F.col("text_hash").alias("b"))
    roots = components(by_print.unionAll(minhash.near_copies(docs, how))).withColumnRenamed("node", "text_hash")
    rooted = firsts.join(roots, "text_hash", "left").withColumn("root", F.coalesce("root", "text_hash"))
    kept = rooted.groupBy("root").agg(F.min("k").alias("k"))
    key, kept_id, kept_hash = (fresh(docs, c) for c in ("_text_hash", "_kept_id", "_kept_hash"))
    kept = kept.select(F.col("k.doc_id").alias(kept_id), F.col("k.text_hash").alias(kept_hash)).distinct()
    rows = docs.withColumn(key, text_hash())
    mine = F.col("doc_id").cast("long").eqNullSafe(F.col(kept_id)) & (F.col(key) == F.col(kept_hash))
    return rows.join(kept, mine, "left_semi").dropDuplicates(["doc_id", key]).drop(key)
