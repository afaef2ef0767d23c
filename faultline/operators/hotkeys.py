"""Equi-joins that survive hot keys, and measured broadcast sizes."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage

HOT_ROWS = 2_000_000
#: Pairs that one task is given to compare, about.
TASK_PAIRS = 1 << 24
BROADCAST_BYTES = 128 << 20
_ROW_OVERHEAD = 32


def measured(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes in memory) of a narrow frame, counted by Spark."""
    width: Column = F.lit(_ROW_OVERHEAD).cast("bigint")
    for f in df.schema.fields:
        size = F.lit(16).cast("bigint")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(f.name), F.lit(0))
        width = width + size
    rows, size = df.agg(F.count(F.lit(1)), F.sum(width)).first()
    return rows, size or 0


def _parts(df: DataFrame, key: str, name: str, hot_rows: int) -> DataFrame:
    """Keys with more than ``hot_rows`` rows and how many parts to cut them into.

    At most total / hot_rows keys, so this is safe to broadcast; the count is
    combined on the map side and reads the key alone.
    """
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > hot_rows)
        .select(key, F.ceil(F.col("_n") / hot_rows).cast("int").alias(name))
    )


def _own_part(df: DataFrame, parts: str) -> Column:
    # Hash and partition number, not rand(): a re-run task deals its rows out
    # the same way, and identical rows still spread by where they are read.
    dealt = F.pmod(F.xxhash64(*df.columns, F.spark_partition_id()), F.col(parts))
    return F.when(F.col(parts) > 1, dealt.cast("int")).otherwise(0)


def _all_parts(parts: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(parts) - 1))


def key_sizes(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, _n, _m): rows on the left and on the right, for keys on both sides."""
    n, m = (df.groupBy(key).agg(F.count(F.lit(1)).alias(c)) for df, c in ((left, "_n"), (right, "_m")))
    return n.join(m, key)


def pairs_of(sizes: DataFrame) -> float:
    """How many pairs a join on the key meets."""
    return sizes.agg(F.sum(F.col("_n").cast("double") * F.col("_m"))).first()[0] or 0.0


def _blocks(sizes: DataFrame, key: str, hot_rows: int, pairs: int) -> DataFrame:
    """Keys with more than ``hot_rows`` rows on a side or more than ``pairs`` pairs, and the
    parts to cut each side into so that a block has no more of either; nearly square blocks
    copy the fewest rows."""

    def parts(mine: str, other: str) -> str:
        return f"cast(ceil({mine} / least({hot_rows}, greatest({math.sqrt(pairs)}D, {pairs} / {other}))) AS int)"

    hot = sizes.filter(f"_n > {hot_rows} OR _m > {hot_rows} OR cast(_n AS double) * _m > {pairs}")
    return hot.selectExpr(key, f"{parts('_n', '_m')} AS _a", f"{parts('_m', '_n')} AS _b")


def salted_join(
    left: DataFrame, right: DataFrame, key: str, hot_rows: int = HOT_ROWS, task_pairs: int | None = None
) -> DataFrame:
    """Inner join on ``key``, hot keys cut into a block of parts on both sides.

    A key with a parts on the left and b on the right becomes a * b smaller
    keys: each left row goes to its own part of a and all of b, and the other
    way round, so every pair still meets exactly once. With ``task_pairs`` keys are
    also cut by the pairs they make, and dealt over as many tasks as the pairs ask for.
    """
    tasks = 0
    if task_pairs:
        sizes = stage(key_sizes(left, right, key))
        hot = (_blocks(sizes, key, hot_rows, task_pairs),)
        tasks = tasks_for(left, 2 * pairs_of(sizes), task_pairs)
    else:
        hot = _parts(left, key, "_a", hot_rows), _parts(right, key, "_b", hot_rows)

    def cut(df: DataFrame, own: str, other: str, mine: str, theirs: str) -> DataFrame:
        out = df
        for table in hot:
            out = out.join(F.broadcast(table), key, "left")
        out = out.fillna(1, ["_a", "_b"])
        out = out.withColumn(own, _own_part(df, mine))
        out = out.withColumn(other, _all_parts(theirs)).drop("_a", "_b")
        return out.repartition(tasks, key, "_l", "_r") if tasks else out

    return cut(left, "_l", "_r", "_a", "_b").join(
        cut(right, "_r", "_l", "_b", "_a"), [key, "_l", "_r"]
    ).drop("_l", "_r")


def tasks_for(df: DataFrame, pairs: float, task_pairs: int) -> int:
    """Tasks over which to deal rows that make ``pairs`` pairs; 0 to leave them as they are.

    Spark deals by bytes; where few bytes make many pairs, that is too few tasks.
    """
    if pairs <= task_pairs:
        return 0
    return max(math.ceil(pairs / task_pairs), df.sparkSession.sparkContext.defaultParallelism)
