"""Table health and inspection."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import size_mb
from ..sources.tables import read_table

# Time columns to look for, in order, and the freshness window.
TIME_COLUMNS = ("processed_at", "analysis_time")
RECENT_MINUTES = 10
SAMPLE_ROWS = 5
AUDIT_SCHEMA = "name string, total long, recent long, status string, note string"


def time_column(df: DataFrame) -> str | None:
    """The first known time column the table has."""
    return next((c for c in TIME_COLUMNS if c in df.columns), None)


def _now(now: datetime | None) -> Column:
    return F.current_timestamp() if now is None else F.lit(now)


def recent(column: str, minutes: int = RECENT_MINUTES, now: datetime | None = None) -> Column:
    """Whether a row's time is within the last ``minutes``."""
    return F.col(column) > _now(now) - F.expr(f"INTERVAL {int(minutes)} MINUTES")


def recent_count(
    df: DataFrame, column: str, minutes: int = RECENT_MINUTES, now: datetime | None = None
) -> DataFrame:
    """Total and recent rows in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(recent(column, minutes, now)).alias("recent"),
    )


def audit_frame(
    df: DataFrame,
    name: str,
    column: str | None = None,
    minutes: int = RECENT_MINUTES,
    now: datetime | None = None,
) -> DataFrame:
    """One audit row for a table: an empty one fails, a stale one only warns."""
    column = column or time_column(df)
    fresh = F.count_if(recent(column, minutes, now)) if column else F.lit(None).cast("bigint")
    counts = df.agg(F.count(F.lit(1)).alias("total"), fresh.alias("recent"))
    total, seen = F.col("total"), F.col("recent")
    status = F.when(total == 0, "FAILED").when(seen == 0, "WARN").otherwise("OK")
    note = (
        F.when(total == 0, "table is empty")
        .when(seen == 0, f"no rows in the last {minutes} minutes")
        .when(seen.isNull(), "no time column")
        .otherwise("")
    )
    return counts.select(
        F.lit(name).alias("name"), "total", "recent", status.alias("status"), note.alias("note")
    )


def audit_tables(
    spark: SparkSession,
    tables: dict[str, str],
    now: datetime | None = None,
    minutes: int = RECENT_MINUTES,
    fmt: str = "parquet",
    columns: dict[str, str] | None = None,
) -> DataFrame:
    """One row per named table; a missing or unreadable table fails.

    Each table is one aggregate of one row. They run here and not lazily, so
    that a broken file fails its own table and not the report.
    """
    rows = []
    for name, path in tables.items():
        try:
            df = read_table(spark, path, fmt)
            row = audit_frame(df, name, (columns or {}).get(name), minutes, now).first()
            rows.append(tuple(row))
        except (PySparkException, Py4JJavaError) as error:
            why = error.getCondition() if isinstance(error, PySparkException) else None
            note = "table does not exist" if why == "PATH_NOT_FOUND" else f"unreadable: {why or 'read error'}"
            rows.append((name, None, None, "FAILED", note))
    return spark.createDataFrame(rows, AUDIT_SCHEMA)


def passed(audit: DataFrame) -> bool:
    """Whether no table failed; warnings pass."""
    return audit.filter(F.col("status") == "FAILED").isEmpty()


def latest_rows(df: DataFrame, n: int = 20, ties: list[str] | None = None) -> DataFrame:
    """Newest rows first by the table's time column, else any n rows."""
    column = time_column(df)
    if column is None:
        return df.limit(n)
    return df.orderBy(F.desc(column), *(ties or [])).limit(n)


def sample_rows(df: DataFrame, n: int = SAMPLE_ROWS) -> DataFrame:
    """Some n rows; Spark reads no further than it must."""
    return df.limit(n)


def table_summary(spark: SparkSession, base: str) -> DataFrame:
    """Files and size of every table in a folder.

    The listing is Spark's own: only names and lengths are read, no contents.
    For Delta tables this counts files on disk; ``delta_detail`` has the live ones.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(base)
        .select("path", "length")
    )
    root = base.split("://")[-1].removeprefix("file:").strip("/")
    # what follows the root, where it first occurs: the same text may come again deeper
    start = F.locate(root + "/", F.col("path")) + len(root) + 1
    inside = F.substring("path", start, F.length("path"))
    return (
        files.groupBy(F.substring_index(inside, "/", 1).alias("table"))
        .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("size_bytes"))
        .withColumn("size_mb", size_mb(F.col("size_bytes")))
    )


def table_rows(spark: SparkSession, tables: dict[str, str], fmt: str = "parquet") -> DataFrame:
    """Row count of each named table, in one job."""
    counts = [
        read_table(spark, path, fmt).agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table"), "rows"
        )
        for name, path in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def table_schema(df: DataFrame, name: str) -> DataFrame:
    """Column, position and type of a table."""
    rows = [(name, i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(
        rows, "table string, position int, column string, type string"
    )


def delta_detail(spark: SparkSession, path: str) -> DataFrame:
    """Files and size as the Delta log has them; needs the Delta package."""
    from delta.tables import DeltaTable

    return (
        DeltaTable.forPath(spark, path)
        .detail()
        .select("numFiles", "sizeInBytes", size_mb(F.col("sizeInBytes")).alias("size_mb"))
    )
