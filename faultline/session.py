"""Session factory and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Streams remember every key: on disk, not on the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC timestamps and adaptive execution.

    Extra settings are keyword arguments with ``__`` for the dots, e.g.
    ``spark__sql__shuffle__partitions="8"``. Sizes (executors, memory, shuffle
    partitions) belong to the cluster and have no default here.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """A new folder name under the cluster's shared checkpoint folder.

    A machine-local folder is used only in local mode with no folder set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="faultline-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/faultline/{uuid.uuid4().hex}"


def stage(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` once as a shared table and read it back.

    Cuts the lineage: a lost executor costs the tasks that read the table, not
    the work that made it.
    """
    path = path or scratch_dir(df.sparkSession)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
