"""Exact top-k by inner product on a bit-sliced index.

Vectors are quantised to integers and dealt into blocks. In a block, each attribute
is stored as bitmaps over the block's rows, one for each bit of its values above
their least (its slices). A query's scores are made for all rows of a block at once:
the slices that the set bits of the query's own values call for are added by weight
with full adders on whole bitmaps; for negative values the complemented slices are
added instead. The result is the score in slices. The top rows come from it from the
most significant slice downward, and rows that tie at the boundary go by id.

Bitmaps are Python integers, whose bitwise operators run over all rows of a block.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

SCALE = 256
#: Rows that a block holds on average, and queries that meet a block in one group.
BLOCK_ROWS = 4096
QUERY_ROWS = 512
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def quantised(vectors: DataFrame, id_: str, vector: str) -> DataFrame:
    """(id, dims, values): floor(SCALE * x) of every component, x as double.

    Vectors that are null or hold null or non-finite components, and rows without
    an id, take no part. Values beyond a long end at its ends. An id that comes
    more than once is one vector, the least by value.
    """
    usable = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    values = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE))
    rows = vectors.filter(F.col(id_).isNotNull() & F.col(vector).isNotNull() & usable)
    rows = rows.select(F.col(id_).cast("long").alias("id"), values.alias("values"))
    rows = rows.groupBy("id").agg(F.min("values").alias("values"))
    return rows.select("id", F.size("values").alias("dims"), "values")


def _bitmap(bits: np.ndarray) -> bytes:
    return np.packbits(bits, bitorder="little").tobytes()


def _index_block(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """One row: the block's ids in order, and least value and slices of each attribute."""
    pdf = pdf.sort_values("id")
    values = np.array(pdf["values"].tolist(), np.int64).reshape(len(pdf), key[0])
    least = values.min(axis=0)
    above = (values.astype(object) - least).astype(np.uint64) if values.size else values.astype(np.uint64)
    slices = [
        [_bitmap(above[:, d] >> np.uint64(j) & np.uint64(1)) for j in range(int(above[:, d].max()).bit_length())]
        for d in range(key[0])
    ]
    return pd.DataFrame({
        "dims": [key[0]], "block": [key[1]], "ids": [pdf["id"].to_numpy()], "least": [least], "slices": [slices]
    })


_INDEX = "dims int, block long, ids array<long>, least array<long>, slices array<array<binary>>"


def build(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The index of quantised rows, one row per block; vectors of different lengths never share one."""
    sizes = rows.groupBy("dims").agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("blocks"))
    dealt = rows.join(sizes, "dims").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    return stage(dealt.select("dims", "block", "id", "values").groupBy("dims", "block").applyInPandas(_index_block, _INDEX))


def _add(columns: list[list[int]]) -> list[int]:
    """Sum of bitmaps by weight, as slices: three of a weight become one and a carry."""
    out = []
    for weight, column in enumerate(columns):
        while len(column) > 1:
            if weight + 1 == len(columns):
                columns.append([])
            x, y = column.pop(), column.pop()
            half = x ^ y
            if column:
                z = column.pop()
                column.append(half ^ z)
                columns[weight + 1].append(x & y | half & z)
            else:
                column.append(half)
                columns[weight + 1].append(x & y)
        out.append(column[0] if column else 0)
    return out


def _scores(query: list[int], least: list[int], slices: list[list[int]], full: int) -> tuple[list[int], int]:
    """Slices of the scores above an offset, and the offset."""
    columns: list[list[int]] = [[] for _ in range(max((len(s) for s in slices), default=0) + 80)]
    offset = 0
    for q, low, own in zip(query, least, slices):
        offset += q * low
        if q < 0:  # q * u = |q| * (top - u) + q * top
            offset += q * ((1 << len(own)) - 1)
            own = [s ^ full for s in own]
            q = -q
        i = 0
        while q >> i:
            if q >> i & 1:
                for j, s in enumerate(own):
                    columns[i + j].append(s)
            i += 1
    while columns and not columns[-1]:
        columns.pop()
    return _add(columns), offset


def _top(slices: list[int], rows: int, k: int) -> int:
    """Bitmap of the k rows of the highest scores among ``rows``; ties to the lowest places."""
    sure, level = 0, rows
    for s in reversed(slices):
        found = sure | level & s
        n = found.bit_count()
        if n > k:
            level &= s
        else:
            sure = found
            level &= ~s
            if n == k:
                return sure
    for _ in range(min(k - sure.bit_count(), level.bit_count())):
        first = level & -level
        sure |= first
        level ^= first
    return sure


def _search(k: int):
    def run(key: tuple, queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, b in block.iterrows():
            ids = b["ids"]
            full = (1 << len(ids)) - 1
            slices = [[int.from_bytes(s, "little") for s in own] for own in b["slices"]]
            least = [int(x) for x in b["least"]]
            place = {int(x): i for i, x in enumerate(ids)}
            for query, values in zip(queries["id"], queries["values"]):
                total, offset = _scores([int(x) for x in values], least, slices, full)
                own = place.get(query)
                top = _top(total, full if own is None else full & ~(1 << own), k)
                while top:
                    at = (top & -top).bit_length() - 1
                    top &= top - 1
                    score = offset + sum((s >> at & 1) << j for j, s in enumerate(total))
                    out.append((query, int(ids[at]), min(MOST, max(LEAST, score))))
        return pd.DataFrame(out, columns=["query_id", "id", "score"]).astype("int64")

    return run


def top_k(rows: DataFrame, chosen: Column, k: int, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, id, score): for each row that ``chosen`` takes, its k best other rows.

    ``rows`` comes from ``quantised``. Queries and index meet block by block, a
    bounded group each, and every query meets every block of vectors of its own
    length once. Ties go to the smaller id; scores beyond a long end at its ends;
    fewer than k other rows give fewer results, none give no rows.
    """
    rows = stage(rows)
    index = build(rows, block_rows)
    queries = rows.filter(chosen)
    groups = queries.groupBy("dims").agg(F.ceil(F.count(F.lit(1)) / query_rows).alias("groups"))
    queries = queries.join(groups, "dims").withColumn("part", F.pmod(F.xxhash64("id"), F.col("groups")))
    blocks = rows.groupBy("dims").agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("blocks"))
    queries = queries.join(blocks, "dims").withColumn("block", F.explode(F.expr("sequence(0L, blocks - 1)")))
    copies = index.join(groups, "dims").withColumn("part", F.explode(F.expr("sequence(0L, groups - 1)"))).drop("groups")
    keys = ["dims", "block", "part"]
    found = (
        queries.select(*keys, "id", "values")
        .groupBy(*keys)
        .cogroup(copies.groupBy(*keys))
        .applyInPandas(_search(k), "query_id long, id long, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "score")
