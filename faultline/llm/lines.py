"""Fuzzy line dedup: MinHash bands, exact Jaccard, distributed union-find.

A line's shingles of SHINGLE characters are hashed and sorted. Around the circle of
hash values there are BANDS starting points; a band is the ROWS least hashes from
its point on, so two lines share it with about the probability of their Jaccard
similarity to the power of ROWS. Lines that share a band are compared exactly: first
each with the least line of the bucket, then, once what is linked is merged, those
of a bucket that are still apart. So a large bucket of near copies costs one
comparison a line, and no link is lost to it. Of the pairs still apart only those are
made whose shingles can be the same often enough: a bit for each of 64 * PARITY slots
says whether an odd number of a line's shingles falls there, and two lines differ in
at least as many shingles as in bits.

Shingles are hashed in NumPy, many lines at a time inside Arrow batches: as Spark
expressions they took more CPU time than the limit allows (see the README).
Everything else is DataFrame operations. Lines are known by a 64-bit hash of the
whole line.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, stage, text_hash
from .components import components

SHINGLE = 6
#: Hashes to a band, and bands: 99.6 % of the pairs at SIMILAR share one, 99.97 % at 0.85.
ROWS, BANDS = 5, 14
SIMILAR = 0.8
#: Bits of the filter of line hashes; its table has 2 ** (FILTER_BITS - 6) rows at most (4 MiB), whatever the input.
FILTER_BITS = 24

_FACTOR = 0x9E3779B97F4A7C15
_POWERS = np.array([pow(_FACTOR, k + 1, 1 << 64) for k in range(max(SHINGLE, ROWS))], np.uint64)
#: The bands' starting points, evenly around the circle of hash values.
_POINTS = np.array([(i << 64) // BANDS for i in range(BANDS)], np.uint64)
#: Stands for no character: fills up lines shorter than a shingle.
_NONE = "\U0010ffff"
#: Longs that hold the parities of a line's shingles, and lines whose parities are taken together.
PARITY, PARITY_LINES = 32, 256
#: Characters hashed together.
AT_ONCE = 1 << 20


def lines(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, line_no, node, line) for every line that isn't blank; line_no from 0."""
    rows = docs.filter(F.col("text").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_hash().alias("text_hash"),
        F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"),
    )
    return rows.filter(F.trim("line") != "").withColumn("node", F.xxhash64("line"))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _parts(lines: list[str]) -> Iterator[slice]:
    """Runs of lines of a bounded number of characters; a longer line is alone."""
    start, size = 0, 0
    for i, line in enumerate(lines):
        if size and size + len(line) > AT_ONCE:
            yield slice(start, i)
            start, size = i, 0
        size += len(line)
    if lines:
        yield slice(start, len(lines))


def shingles(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each line's shingles, sorted and one line after the other, and their numbers.

    A line shorter than a shingle is one.
    """
    lines = [x if len(x) >= SHINGLE else x.ljust(SHINGLE, _NONE) for x in lines]
    sizes = np.array([len(x) for x in lines])
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    n = len(codes) - SHINGLE + 1
    hashes = codes[:n] * _POWERS[0]
    for k in range(1, SHINGLE):
        hashes += codes[k : k + n] * _POWERS[k]
    place = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    hashes = _mixed(hashes[(place <= np.repeat(sizes - SHINGLE, sizes))[:n]])
    ends = np.cumsum(sizes - SHINGLE + 1)
    starts = np.concatenate([[0], ends[:-1]])
    for a, b in zip(starts.tolist(), ends.tolist()):
        hashes[a:b].sort()
    first = np.concatenate([[True], hashes[1:] != hashes[:-1]])
    first[starts] = True
    return hashes[first], np.add.reduceat(first, starts, dtype=np.int64)


def bands(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A key for each band of each line, given the sorted shingle hashes of the lines."""
    starts = np.cumsum(counts) - counts
    keys = np.empty((len(counts), BANDS), np.uint64)
    for i, point in enumerate(_POINTS):
        first = np.add.reduceat(hashes < point, starts, dtype=np.int64)  # the least hash from the point on
        key = np.full(len(counts), i, np.uint64)
        for k in range(ROWS):
            key += hashes[starts + (first + k) % counts] * _POWERS[k]
        keys[:, i] = _mixed(key)
    return keys.view(np.int64)


def parities(hashes: np.ndarray, counts: np.ndarray, longs: int = PARITY) -> np.ndarray:
    """For each set of hashes, a bit for each of 64 * longs slots: whether an odd number of them falls there."""
    bits, ends = 64 * longs, np.cumsum(counts)
    out = np.empty((len(counts), longs), np.int64)
    for at in range(0, len(counts), PARITY_LINES):
        n = counts[at : at + PARITY_LINES]
        slot = hashes[ends[at] - n[0] : ends[at + len(n) - 1]] & np.uint64(bits - 1)
        slot = slot.astype(np.int64) + np.repeat(np.arange(len(n)) * bits, n)
        odd = np.bincount(slot, minlength=len(n) * bits) & 1
        out[at : at + len(n)] = np.packbits(odd.astype(np.uint8).reshape(len(n), bits), axis=1).view(np.int64)
    return out


def parity_columns(longs: int = PARITY) -> list[str]:
    return [f"odd{i}" for i in range(longs)]


def may_link(percent: int, longs: int = PARITY) -> Column:
    """Whether x and y (size, parities) can share ``percent`` % of their union; never wrongly no.

    Of n elements in both sizes together, sets that do differ in n * (100 - percent) / (100 + percent) at most.
    """
    differ = " + ".join(f"bit_count(x.{c} ^ y.{c})" for c in parity_columns(longs))
    return F.expr(f"({differ}) * {100 + percent} <= {100 - percent} * (x.size + y.size)")


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lines, nodes = b.column("line").to_pylist(), b.column("node")
        for part in _parts(lines):
            hashes, counts = shingles(lines[part])
            marks = [pa.array(x) for x in np.ascontiguousarray(parities(hashes, counts).T)]
            yield pa.RecordBatch.from_arrays(
                [nodes[part.start : part.stop], pa.array(counts), *marks], ["node", "size", *parity_columns()]
            )


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lines, nodes = b.column("line").to_pylist(), b.column("node")
        for part in _parts(lines):
            keys = bands(*shingles(lines[part]))
            ends = pa.array(np.arange(0, keys.size + 1, BANDS), pa.int32())
            lists = pa.ListArray.from_arrays(ends, pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([nodes[part.start : part.stop], lists], ["node", "bands"])


def banded(rows: DataFrame, banding=_banded) -> DataFrame:
    """(node, bands), one row per distinct line."""
    return rows.select("node", "line").mapInArrow(banding, "node long, bands array<long>").dropDuplicates(["node"])


def _among(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """``rows`` whose node is in ``nodes`` (distinct): a filter of fixed size first, then the join."""
    bit = F.col("node").bitwiseAND(F.lit((1 << FILTER_BITS) - 1).cast("long"))
    slot = F.shiftright(bit, 6).cast("int")
    place = bit.bitwiseAND(F.lit(63).cast("long")).cast("int")
    masks = nodes.select(slot.alias("_slot"), F.expr("shiftleft(1L, cast(node & 63 as int))").alias("_bit"))
    masks = masks.groupBy("_slot").agg(F.bit_or("_bit").alias("_mask"))
    near = rows.withColumn("_slot", slot).withColumn("_place", place).join(F.broadcast(masks), "_slot")
    near = near.filter(F.getbit("_mask", F.col("_place")) == 1).drop("_slot", "_place", "_mask")
    return near.join(nodes, "node", "left_semi")


def jaccard(x: list[str], y: list[str]) -> list[float]:
    """Of each line of ``x`` with that of ``y`` in its place."""
    (one, n), (two, m) = shingles(x), shingles(y)
    out = []
    for a, i, b, j in zip((np.cumsum(n) - n).tolist(), n.tolist(), (np.cumsum(m) - m).tolist(), m.tolist()):
        both = len(np.intersect1d(one[a : a + i], two[b : b + j], assume_unique=True))
        out.append(both / (i + j - both))
    return out


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x, y = b.column("x").to_pylist(), b.column("y").to_pylist()
        same = [s >= SIMILAR for part in _parts(x) for s in jaccard(x[part], y[part])]
        yield b.select(["a", "b"]).filter(pa.array(same, pa.bool_()))


def _similar(pairs: DataFrame, texts: DataFrame, comparing=_compared) -> DataFrame:
    """The pairs (a, b) of nodes whose lines are similar enough for ``comparing``."""
    one = texts.select(F.col("node").alias("a"), F.col("line").alias("x"))
    two = texts.select(F.col("node").alias("b"), F.col("line").alias("y"))
    met = pairs.join(one, "a").join(two, "b")
    return met.select("a", "b", "x", "y").mapInArrow(comparing, "a long, b long")


def links(rows: DataFrame, banding=_banded, comparing=_compared) -> DataFrame:
    """(a, b): links between nodes of lines; enough of them to connect all that are similar.

    ``banding`` and ``comparing`` say what similar means, by default as in the module's head;
    another ``comparing`` gets all pairs of a bucket that are apart.
    """
    keys = banded(rows, banding).select("node", F.explode("bands").alias("band"))
    bucket = Window.partitionBy("band")
    met = keys.select("node", "band", F.min("node").over(bucket).alias("head"), F.max("node").over(bucket).alias("last"))
    met = stage(met.filter("head < last").select("node", "band", "head"))
    texts = stage(_among(rows.select("node", "line"), met.select("node").distinct()).dropDuplicates(["node"]))
    stars = met.filter("node > head").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
    first = stage(_similar(stars, texts, comparing))
    roots = components(first)
    merged = met.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    same = Window.partitionBy("band")
    apart = merged.withColumn("_lo", F.min("root").over(same)).withColumn("_hi", F.max("root").over(same))
    apart = stage(apart.filter("_lo < _hi").select("band", "node", "root", "head"))
    pair = (F.col("x.band") == F.col("y.band")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.root") != F.col("y.root"))
    if comparing is _compared:
        marks = texts.join(apart.select("node").distinct(), "node", "left_semi")
        marks = marks.mapInArrow(_marked, "node long, size long, " + ", ".join(f"{c} long" for c in parity_columns()))
        apart = apart.join(stage(marks), "node")
        pair = pair & may_link(round(100 * SIMILAR))
    rest = apart.alias("x").join(apart.alias("y"), pair)
    rest = rest.filter("x.node <> x.head")  # pairs with the bucket's head have been compared
    rest = rest.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
    return first.unionAll(_similar(rest, texts, comparing))


def duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, line_no, kept_doc_id, kept_text_hash, kept_line_no): every line that goes.

    Of the lines of a component, exact repeats included, the first by doc_id, text
    hash and line number stays (a null doc_id comes before all). Defined cases: blank
    lines and null texts take no part; lines shorter than a shingle are the same only
    if equal; rows that repeat a document share their decisions, so each repeat
    loses the same lines; no documents give no rows. Lines are compared whole.
    """
    rows = lines(docs)
    roots = components(links(rows))
    places = stage(rows.select("node", "doc_id", "text_hash", "line_no").distinct())
    placed = places.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")).drop("node")
    first = F.min(F.struct("doc_id", "text_hash", "line_no")).alias("kept")
    kept = placed.groupBy("root").agg(first, F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    place = F.struct("doc_id", "text_hash", "line_no")
    gone = placed.join(kept, "root").filter(~place.eqNullSafe(F.col("kept")))
    return gone.select(
        "doc_id",
        "text_hash",
        "line_no",
        F.col("kept.doc_id").alias("kept_doc_id"),
        F.col("kept.text_hash").alias("kept_text_hash"),
        F.col("kept.line_no").alias("kept_line_no"),
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with the texts' duplicate lines left out; all rows and columns stay."""
    key, gone_id, gone_hash, gone = (fresh(docs, c) for c in ("_text_hash", "_gone_id", "_gone_hash", "_gone"))
    lost = duplicates(docs).groupBy(F.col("doc_id").alias(gone_id), F.col("text_hash").alias(gone_hash))
    lost = lost.agg(F.collect_set("line_no").alias(gone))  # at most the lines of one text
    rows = docs.withColumn(key, text_hash())
    mine = F.col("doc_id").cast("long").eqNullSafe(F.col(gone_id)) & (F.col(key) == F.col(gone_hash))
    rows = rows.join(lost, mine, "left").drop(key, gone_id, gone_hash)
    left = F.filter(F.split("text", "\n", -1), lambda _, i: ~F.array_contains(gone, i))
    return rows.withColumn("text", F.when(F.col(gone).isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))).drop(gone)
