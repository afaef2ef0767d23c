"""Exports: CSV rows, keyed JSON messages and a console preview."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.render import csv_rows


def export_events_csv(raw: DataFrame, path: str) -> None:
    """Append raw event messages to a folder of CSV files with headers."""
    (
        csv_rows(raw)
        .write.mode("append")
        .option("header", True)
        .option("emptyValue", "")
        .csv(path)
    )


def to_keyed_json(df: DataFrame, key: str) -> DataFrame:
    """Messages for a topic: ``key`` and the row as JSON in ``value``."""
    return df.select(
        F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value")
    )


def publish(messages: DataFrame, fmt: str = "kafka", path: str | None = None, **options) -> None:
    """Send keyed messages to a topic, or append them to a folder."""
    messages.write.format(fmt).mode("append").options(**options).save(path)


def preview(df: DataFrame, n: int = 10, columns: list[str] | None = None) -> None:
    (df.select(*columns) if columns else df).show(n, truncate=False)
