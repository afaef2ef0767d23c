"""Message sources: a broker topic, or files that hold one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import MESSAGE


def source_options(fmt: str, fail_on_data_loss: bool, starting_offsets: str, options: dict) -> dict:
    """Options for the reader; those given by the source's own names win over the arguments."""
    if fmt != "kafka":
        return dict(options)
    own = {"startingOffsets": starting_offsets, "failOnDataLoss": str(fail_on_data_loss).lower()}
    given = {name.lower() for name in options}
    return {k: v for k, v in own.items() if k.lower() not in given} | options


def read_messages(
    spark: SparkSession,
    fmt: str = "kafka",
    path: str | None = None,
    streaming: bool = True,
    fail_on_data_loss: bool = True,
    starting_offsets: str = "earliest",
    **options: str,
) -> DataFrame:
    """Messages with ``value`` and ``timestamp`` (arrival time).

    ``fmt="kafka"`` needs the connector on the class path and takes its options
    as a mapping, e.g. ``**{"kafka.bootstrap.servers": ..., "subscribe": ...}``.
    ``"text"`` reads one message per line and takes the file's time as arrival
    time; any other format reads tables of key, value, timestamp.
    """
    given = source_options(fmt, fail_on_data_loss, starting_offsets, options)
    reader = (spark.readStream if streaming else spark.read).format(fmt).options(**given)
    if fmt == "kafka":
        return reader.load()
    if fmt == "text":
        return reader.load(path).select(
            "value", F.col("_metadata.file_modification_time").alias("timestamp")
        )
    return reader.schema(MESSAGE).load(path)


def read_events(spark: SparkSession, **source) -> DataFrame:
    """Raw event messages: ``value``."""
    return read_messages(spark, **source).select("value")


def read_stations(spark: SparkSession, **source) -> DataFrame:
    """Raw station messages: ``value`` and the broker's ``timestamp``."""
    return read_messages(spark, **source).select("value", "timestamp")
