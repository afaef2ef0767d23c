"""Duplicates: stateful, ordered, and latest revision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Dedup keys of the two streams.
EVENT_KEY = ["unid"]
STATION_KEY = ["region", "create_at", "latitude", "longitude"]


def dedup(
    df: DataFrame, keys: list[str], watermark: str | None = None, time_col: str = "event_time"
) -> DataFrame:
    """First-seen row per key, in batch or streaming.

    Without ``watermark`` every key is kept for ever, in a state store on disk,
    and no row is lost. With it a stream's state is bounded: a key is forgotten
    once the watermark has passed its row, a later repeat is admitted again, rows
    behind the watermark are **dropped** even if their key is new, and rows
    without a time aren't compared. Only use it where that is wanted.
    """
    if watermark and df.isStreaming:
        return df.withWatermark(time_col, watermark).dropDuplicatesWithinWatermark(keys)
    return df.dropDuplicates(keys)


def _one_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    # Spark keeps one row per key and task before the shuffle (WindowGroupLimit),
    # so a hot key sends one row per task, not all its rows.
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def first_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row per key under ``order``: the same survivor on every run."""
    return _one_by(df, keys, [F.col(c).asc_nulls_last() for c in order])


def latest_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The latest revision per key: greatest ``order``, NULL counting as oldest."""
    return _one_by(df, keys, [F.col(c).desc_nulls_last() for c in order])
