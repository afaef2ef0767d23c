"""Tables: scans, writes and a log of writes."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import SITES_CSV

LOG_SCHEMA = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("operation", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("written_at", T.TimestampType()),
    ]
)


def read_sites_csv(spark: SparkSession, path: str) -> DataFrame:
    """Sites CSV under its fixed schema; a file with other header names fails."""
    return (
        spark.read.schema(SITES_CSV)
        .option("header", True)
        .option("enforceSchema", False)
        .csv(path)
    )


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def stream_table(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None, **options
) -> DataFrame:
    """Rows appended to a table, as a stream.

    File formats need a schema; it is taken from the table when not given.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if fmt != "delta":
        reader = reader.schema(schema or spark.read.format(fmt).load(path).schema)
    return reader.load(path)


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "append",
    fmt: str = "parquet",
    replace_schema: bool = False,
    partition_by: list[str] | None = None,
    log: str | None = None,
) -> None:
    """Append to or overwrite a table; ``log`` records the write.

    The row count in the log is observed while the rows are written, so it
    costs no second pass.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode must be append or overwrite, not {mode!r}")
    seen = Observation()
    writer = (df.observe(seen, F.count(F.lit(1)).alias("rows")) if log else df).write
    writer = writer.format(fmt).mode("overwrite" if replace_schema else mode)
    if replace_schema and fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    if log:
        _record(df.sparkSession, log, path, "overwrite" if replace_schema else mode, seen.get["rows"])


def _record(spark: SparkSession, log: str, table: str, operation: str, rows: int) -> None:
    last = (
        read_log(spark, log).filter(F.col("table") == table).agg(F.max("version")).first()[0]
    )
    entry = [(table, 0 if last is None else last + 1, operation, rows)]
    (
        spark.createDataFrame(entry, "table string, version long, operation string, rows long")
        .withColumn("written_at", F.current_timestamp())
        .coalesce(1)
        .write.mode("append")
        .parquet(log)
    )


def read_log(spark: SparkSession, log: str) -> DataFrame:
    """Log of writes; empty when nothing has been written yet."""
    try:
        return spark.read.schema(LOG_SCHEMA).parquet(log)
    except AnalysisException:
        return spark.createDataFrame([], LOG_SCHEMA)


def table_history(
    spark: SparkSession, path: str, n: int = 3, log: str | None = None, fmt: str = "parquet"
) -> DataFrame:
    """The last ``n`` writes of a table, newest first."""
    if fmt == "delta":
        from delta.tables import DeltaTable

        return DeltaTable.forPath(spark, path).history(n)
    return (
        read_log(spark, log)
        .filter(F.col("table") == path)
        .orderBy(F.desc("version"))
        .limit(n)
    )
