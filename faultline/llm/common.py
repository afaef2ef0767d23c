"""Inputs, staging and row identity shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_dir, stage

__all__ = ["bound", "documents", "fresh", "positions", "read", "scratch_dir", "stage", "staged_zstd", "text_hash"]


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, though lambdas inside use it again and again."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents")


def staged_zstd(df: DataFrame) -> DataFrame:
    """``stage`` for wide payloads: smaller files for more CPU time."""
    path = scratch_dir(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_hash(text: str | Column = "text") -> Column:
    """Tells rows that repeat a doc_id with other texts apart; null and empty agree."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have yet, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def positions(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` with its place from 0 in the given total order as ``position``.

    Rows are dealt out by range, counted per partition, and ranked inside; no task
    sees more than a partition and one count for each.
    """
    part = F.spark_partition_id()
    dealt = stage(df.repartitionByRange(*order).withColumn("_part", part))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    starts = counts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    rank = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    ranked = dealt.withColumn("_rank", rank).join(starts, "_part")
    return ranked.withColumn("position", F.col("_start") + F.col("_rank")).drop("_part", "_start", "_rank")
