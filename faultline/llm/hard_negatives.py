"""Hard negatives by inner product, found with rotated one-bit codes.

Vectors are quantised to integers. A vector is rotated and replaced by the signs of
its components, one bit each; its alignment with that code vector is stored, and what
the aligned code leaves over is coded again, LEVELS times, each time under another
rotation. An anchor's rotated components are cut into bit planes, so its product with
a code is a sum of popcounts. Products with the codes, times the alignments, estimate
the score; the part left over can change it by no more than the product of two norms
(Cauchy-Schwarz), which with the rounding of the planes gives an interval that holds
the score for certain. Rows whose interval can't matter are left out, level by level,
and the rest is scored with integers. So nothing rests on chance: the codes decide
how much is scored, not what comes out.

Anchors meet all rows in blocks: one packed row for each group of anchors and one
for each block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

SCALE = 256
#: Rows in a block and anchors in a group, on average.
BLOCK_ROWS, GROUP_ROWS = 4096, 256
#: Codes of a vector, and bits of an anchor's rotated components.
LEVELS, PLANES = 3, 8
#: Intervals are this much wider, relative to the norms, for the rounding of floating point.
SLACK = 1e-9
LEAST, MOST = -(1 << 63), (1 << 63) - 1

_ROW = "id long, label long, copies long"


def usable(vectors: DataFrame, id_: str, vector: str, label: Column) -> DataFrame:
    """(id, label, dims, values, copies): floor(SCALE * x) of every component, x as double.

    Rows without an id, a label or a vector, and those holding a null or non-finite
    component, take no part. Values beyond a long end at its ends. Equal rows are one
    with their number as ``copies``; rows that share an id alone stay apart.
    """
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.filter(F.col(id_).isNotNull() & label.isNotNull() & F.col(vector).isNotNull() & ~bad)
    values = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE))
    rows = rows.select(F.col(id_).cast("long").alias("id"), label.cast("long").alias("label"), values.alias("values"))
    rows = rows.groupBy("id", "label", "values").agg(F.count(F.lit(1)).alias("copies"))
    return rows.withColumn("dims", F.size("values"))


def rotation(dims: int, level: int) -> np.ndarray:
    """An orthogonal matrix, the same for every task."""
    return np.linalg.qr(np.random.default_rng([dims, level]).normal(size=(dims, dims)))[0]


def encode(values: np.ndarray, levels: int = LEVELS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (level, row, byte), alignments (level, row) and the norms of what they leave (level, row)."""
    n, dims = values.shape
    left, codes, along, norms = values.astype(float), [], [], []
    for level in range(levels):
        turn = rotation(dims, level)
        turned = left @ turn
        signs = turned >= 0
        codes.append(np.packbits(signs, axis=1, bitorder="little"))
        along.append(np.abs(turned).sum(axis=1) / dims**0.5)
        left = left - along[-1][:, None] * ((2.0 * signs - 1) / dims**0.5) @ turn.T
        norms.append(np.linalg.norm(left, axis=1))
    return np.array(codes).reshape(levels, n, -1), np.array(along), np.array(norms)


def planes(turned: np.ndarray) -> tuple[np.ndarray, float, float, float, float]:
    """Bit planes of an anchor's rotated components: bits, least, step, sum of numbers, sum of errors."""
    low = float(turned.min())
    step = (float(turned.max()) - low) / ((1 << PLANES) - 1) or 1.0
    numbers = np.rint((turned - low) / step).astype(np.int64)
    bits = np.packbits(numbers >> np.arange(PLANES)[:, None] & 1, axis=1, bitorder="little").astype(np.uint8)
    return bits, low, step, float(numbers.sum()), float(np.abs(turned - low - step * numbers).sum())


class Anchor:
    """An anchor's side of the intervals."""

    def __init__(self, values: np.ndarray, turns: list[np.ndarray]):
        self.values = values
        self.norm = float(np.linalg.norm(values.astype(float)))
        self.planes = [planes(values.astype(float) @ t) for t in turns]

    def product(self, level: int, codes: np.ndarray) -> np.ndarray:
        """Estimates of the products with unit code vectors."""
        bits, low, step, total, _ = self.planes[level]
        dims = len(self.values)
        on = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
        met = np.bitwise_count(codes[:, None, :] & bits).sum(axis=2, dtype=np.int64) @ (1 << np.arange(PLANES))
        return (low * (2 * on - dims) + step * (2 * met - total)) / dims**0.5

    def error(self, level: int) -> float:
        return self.planes[level][-1] / len(self.values) ** 0.5


def intervals(anchor: Anchor, block: Block, wanted: Callable, rows: np.ndarray) -> np.ndarray:
    """The rows that are left after all levels. ``wanted(rows, low, high)`` is a mask of those that may matter."""
    middle, doubt = np.zeros(len(rows)), np.zeros(len(rows))
    for level in range(len(block.along)):
        along = block.along[level][rows]
        product = anchor.product(level, block.codes[level][rows])
        middle, doubt = middle + along * product, doubt + along * anchor.error(level)
        # what is left over is at right angles to the last code, so only that part of the anchor counts
        across = anchor.norm**2 - np.maximum(0, np.abs(product) - anchor.error(level)) ** 2
        wide = doubt + block.norms[level][rows] * np.sqrt(np.maximum(0, across)) + SLACK * anchor.norm * block.size[rows]
        keep = wanted(rows, *np.clip((middle - wide, middle + wide), LEAST, MOST))
        rows, middle, doubt = rows[keep], middle[keep], doubt[keep]
    return rows


class Block:
    """The packed rows of a block."""

    def __init__(self, packed: pd.Series, dims: int):
        self.ids, self.labels, self.copies = (np.asarray(packed[c], np.int64) for c in ("ids", "labels", "copies"))
        n = len(self.ids)
        self.values = np.frombuffer(packed["values"], np.int64).reshape(n, dims)
        self.along = np.frombuffer(packed["along"], float).reshape(-1, n)
        self.norms = np.frombuffer(packed["norms"], float).reshape(-1, n)
        self.codes = np.frombuffer(packed["codes"], np.uint8).reshape(len(self.along), n, max(1, -(-dims // 8)))
        self.size = np.linalg.norm(self.values.astype(float), axis=1)

    def scores(self, anchor: Anchor, rows: np.ndarray) -> np.ndarray:
        """Integer products; those beyond a long end at its ends."""
        if anchor.norm * self.size[rows].max(initial=0) < MOST / 2:
            return self.values[rows] @ anchor.values
        exact = self.values[rows].astype(object) @ anchor.values.astype(object)
        return np.array([min(MOST, max(LEAST, x)) for x in exact], np.int64)


def _pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["id", "label"])
    values = np.array(pdf["values"].tolist(), np.int64).reshape(len(pdf), key[0])
    codes, along, norms = encode(values) if key[0] else [np.zeros((0, len(pdf)))] * 3
    return pd.DataFrame({
        "dims": [key[0]], "block": [key[1]], "ids": [pdf["id"].to_numpy()], "labels": [pdf["label"].to_numpy()],
        "copies": [pdf["copies"].to_numpy()], "values": [values.tobytes()], "codes": [codes.tobytes()],
        "along": [along.tobytes()], "norms": [norms.tobytes()],
    })


_LISTS = "ids array<long>, labels array<long>, copies array<long>, values binary"
_PACKED = f"dims int, block long, {_LISTS}, codes binary, along binary, norms binary"


def _dealt(rows: DataFrame, size: int) -> DataFrame:
    """``rows`` with a block of about ``size`` rows, by hash of the whole row."""
    sizes = rows.groupBy("dims").agg(F.ceil(F.count(F.lit(1)) / size).alias("_blocks"))
    hashed = F.pmod(F.xxhash64("id", "label", "values"), F.col("_blocks"))
    return rows.join(sizes, "dims").withColumn("block", hashed).drop("_blocks")


def build(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The index of usable rows, one packed row per block; vectors of different lengths never share one."""
    return stage(_dealt(rows, block_rows).groupBy("dims", "block").applyInPandas(_pack, _PACKED))


def _group(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["id", "label"])
    values = np.array(pdf["values"].tolist(), np.int64).reshape(len(pdf), key[0])
    return pd.DataFrame({
        "dims": [key[0]], "part": [key[1]], "ids": [pdf["id"].to_numpy()], "labels": [pdf["label"].to_numpy()],
        "copies": [pdf["copies"].to_numpy()], "values": [values.tobytes()],
    })


def _grouped(anchors: DataFrame, group_rows: int) -> DataFrame:
    """Anchors packed in groups; an anchor is known by (dims, part, place) from here on."""
    dealt = _dealt(anchors, group_rows).withColumnRenamed("block", "part")
    return stage(dealt.groupBy("dims", "part").applyInPandas(_group, f"dims int, part long, {_LISTS}"))


def _pairs(groups: DataFrame, index: DataFrame, schema: str, search: Callable) -> DataFrame:
    """Every group meets every block of its dims once, packed; ``search(group, block)`` gives the rows."""
    parts = groups.groupBy("dims").agg(F.collect_set("part").alias("_parts"))
    blocks = index.groupBy("dims").agg(F.collect_set("block").alias("_blocks"))
    left = groups.join(blocks, "dims").withColumn("block", F.explode("_blocks")).drop("_blocks")
    right = index.join(parts, "dims").withColumn("part", F.explode("_parts")).drop("_parts")
    key = ["dims", "part", "block"]

    def run(key: tuple, group: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        dims = int(key[0])
        one, rows = group.iloc[0], Block(block.iloc[0], dims)
        turns = [rotation(dims, level) for level in range(len(rows.along))]
        values = np.frombuffer(one["values"], np.int64).reshape(len(one["ids"]), dims)
        found = []
        for place in range(len(values)):
            anchor = Anchor(values[place], turns)
            found += [(key[0], key[1], place, *row) for row in search(one, place, anchor, rows)]
        return pd.DataFrame(found, columns=names)

    schema = f"dims int, part long, place int, {schema}"
    names = [c.split()[0] for c in schema.split(", ")]
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(run, schema)


def _kth(low: np.ndarray, copies: np.ndarray, k: int) -> float:
    """A bound that k rows, copies counted, are sure to reach; minus infinity for fewer rows."""
    order = np.argsort(-low, kind="stable")
    reached = np.searchsorted(np.cumsum(copies[order]), k)
    return float(low[order[reached]]) if reached < len(low) else -np.inf


def _best(ids: np.ndarray, scores: np.ndarray, copies: np.ndarray, k: int) -> Iterator[tuple[int, int, int]]:
    """(id, score, copies) of the first rows that make up k, copies counted."""
    for i in np.lexsort((ids, -scores)):
        if k <= 0:
            return
        yield int(ids[i]), int(scores[i]), min(k, int(copies[i]))
        k -= int(copies[i])


def _like(k: int) -> Callable:
    def search(group: pd.Series, place: int, anchor: Anchor, block: Block) -> Iterator[tuple]:
        label, id_ = int(group["labels"][place]), int(group["ids"][place])
        copies = block.copies
        own = (block.ids == id_) & (block.labels == label)
        if own.any():  # one copy of the anchor itself is no partner
            own &= (block.values == anchor.values).all(axis=1)
            copies = copies - own
        rows = np.flatnonzero((block.labels == label) & (copies > 0))
        left = intervals(anchor, block, lambda r, low, high: high >= _kth(low, copies[r], k), rows)
        yield from _best(block.ids[left], block.scores(anchor, left), copies[left], k)

    return search


def _unlike(k: int, least: int, most: int) -> Callable:
    def search(group: pd.Series, place: int, anchor: Anchor, block: Block) -> Iterator[tuple]:
        scores = sorted({int(s) for s in group["scores"][place]})
        windows = [(-(-least * s // 100), most * s // 100) for s in scores]

        def wanted(rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
            keep = np.zeros(len(rows), bool)
            for a, b in windows:
                inside = (low >= a) & (high <= b)
                keep |= (high >= max(a, _kth(low[inside], block.copies[rows[inside]], k))) & (low <= b)
            return keep

        rows = intervals(anchor, block, wanted, np.flatnonzero(block.labels != group["labels"][place]))
        found = block.scores(anchor, rows)
        for score, (a, b) in zip(scores, windows):
            mine = (found >= a) & (found <= b)
            for best in _best(block.ids[rows[mine]], found[mine], block.copies[rows[mine]], k):
                yield score, *best

    return search


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The first k of each key by score, then id, copies spelled out (k at most)."""
    each = found.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("copies", "_copy")
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return each.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(
    rows: DataFrame,
    chosen: Column,
    positives: int = 5,
    negatives: int = 5,
    percent: tuple[int, int] = (80, 100),
    block_rows: int = BLOCK_ROWS,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Per anchor and positive the best rows of other labels within ``percent`` of the positive's score.

    ``rows`` comes from ``usable``, anchors are those that ``chosen`` takes. Columns:
    anchor_id, positive_id, positive_rank, rank, negative_id, positive_score,
    negative_score. Higher scores come first, ties by smaller id. Defined cases: a
    positive with a score below 0 has no negatives; fewer rows than asked for give
    fewer; equal rows count as often as they are there, also as anchors; vectors of
    different lengths don't meet; no anchors give no rows. ``percent`` is of scores
    that are 0 or more, its first number no larger than its second.
    """
    rows = stage(rows)
    index = build(rows, block_rows)
    groups = _grouped(rows.filter(chosen), group_rows)
    anchor = ["dims", "part", "place"]
    near = _pairs(groups, index, "id long, score long, copies long", _like(positives))
    near = stage(_first(near, anchor, positives).withColumnRenamed("rank", "positive_rank"))
    scored = near.groupBy(*anchor).agg(F.collect_set("score").alias("scores"))  # as many as positives, at most
    lists = F.map_from_entries(F.collect_list(F.struct("place", "scores"))).alias("_scores")
    by_group = scored.groupBy("dims", "part").agg(lists)  # a group's anchors, at most
    none = F.array().cast("array<long>")
    places = F.transform("ids", lambda _, i: F.coalesce(F.element_at("_scores", i), none))
    asking = stage(groups.join(by_group, ["dims", "part"]).withColumn("scores", places).drop("_scores"))
    far = _pairs(asking, index, "asked long, id long, score long, copies long", _unlike(negatives, *percent))
    far = _first(far, [*anchor, "asked"], negatives).select(
        *anchor, F.col("asked").alias("positive_score"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    near = near.select(*anchor, "positive_rank", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    who = groups.select("dims", "part", F.posexplode(F.arrays_zip("ids", "copies")).alias("place", "who"))
    who = who.select(*anchor, F.col("who.ids").alias("anchor_id"), F.explode(F.sequence(F.lit(1), F.col("who.copies").cast("int"))).alias("copy"))
    found = far.join(near, [*anchor, "positive_score"]).join(who, anchor)
    names = ["anchor_id", "positive_id", "positive_rank", "rank", "negative_id", "positive_score", "negative_score"]
    return found.select(*names)
