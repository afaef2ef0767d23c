"""Accounted ingestion: each message of a stream is accepted, a repeat, late or rejected.

A feed is read and parsed once; every micro-batch writes its accepted rows, its late
rows and its rejects to tables of their own, and how many messages had which outcome.

Repeats are told by a ledger of keys on disk, dealt into buckets by hash, not by a
state store that holds every key. A bitmap of fixed size says which keys of a batch
can't have come before; only for the others are the ledger's buckets read, and only
those that the batch touches. So a batch costs its own size plus its buckets, and the
memory it takes doesn't grow with the history. With ``late_after`` rows that far behind
the newest earlier event are late: they are kept in their table, and keys older than
that leave the ledger.

All of it is written per batch into folders that a repeat of the batch replaces, and a
batch reads only what earlier ones wrote, so it may run again after a failure.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.dedup import first_by
from ..operators.ingest import stamp
from .streams import batch_stream, into_batch_folder

#: Parts of the ledger, words of 64 bits in each part's bitmap, and batches after which keys are merged.
BUCKETS, WORDS, MERGE_EVERY = 64, 4096, 32
#: Parts that each split of a batch is dealt into, and bytes of messages that a task then gets, about.
PARTS, TASK_BYTES = 16, 32 << 20

_KEY = ["_k1", "_k2"]


@dataclass(frozen=True)
class Accounts:
    """Where an accounted feed lies: the table, and beside it what the account needs."""

    root: str

    def at(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def read(self, spark: SparkSession, name: str, fmt: str = "parquet") -> DataFrame:
        """``accepted``, ``late``, ``rejects`` or ``outcomes``."""
        return spark.read.format(fmt).load(self.at(name))

    def totals(self, spark: SparkSession, fmt: str = "parquet") -> DataFrame:
        """(outcome, reason, messages) over all batches; failed counts messages of attempts that failed."""
        found = self.read(spark, "outcomes", fmt).select("outcome", "reason", "messages")
        failed = _existing(spark, self.at("failed"), "outcome string, reason string, messages long", fmt)
        total = F.sum("messages").alias("messages")
        return found.unionByName(failed).groupBy("outcome", "reason").agg(total).filter("messages > 0")


def _existing(spark: SparkSession, path: str, schema: str, fmt: str) -> DataFrame:
    """The table at ``path``, or none of its rows where it isn't there yet."""
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def with_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds 128 bits of the keys, nulls told apart, their bucket, and their word and bits in the bitmap."""
    parts = [c for k in keys for c in (F.col(k).isNull(), F.col(k))]
    df = df.withColumns({"_k1": F.xxhash64(*parts), "_k2": F.xxhash64(F.lit(1), *parts)})
    places = {
        "_bucket": F.pmod("_k1", F.lit(BUCKETS)).cast("int"),
        "_word": F.pmod(F.shiftright("_k1", 20), F.lit(WORDS)).cast("int"),
        "_bits": F.expr("shiftleft(1L, cast(_k2 & 63 as int)) | shiftleft(1L, cast(shiftright(_k2, 6) & 63 as int))"),
    }
    return df.withColumns(places)


class Ledger:
    """The keys that batches have accepted, as seen by batch ``n``."""

    schema = "_k1 long, _k2 long, _at timestamp, _bucket int"

    def __init__(self, spark: SparkSession, path: str, n: int, fmt: str = "parquet"):
        self.spark, self.path, self.n, self.fmt = spark, path, n, fmt

    def _two(self, name: str, n: int) -> str:
        # Two folders in turn: a batch reads the one that its predecessor wrote.
        return f"{self.path}/{name}/{n % 2}"

    def newest(self):
        """The newest time of earlier batches, or None."""
        if not self.n:
            return None
        return _existing(self.spark, self._two("clock", self.n - 1), "at timestamp", self.fmt).agg(F.max("at")).first()[0]

    def bitmap(self) -> DataFrame:
        schema = "_bucket int, _word int, _seen long"
        if not self.n:
            return self.spark.createDataFrame([], schema)
        return _existing(self.spark, self._two("bitmap", self.n - 1), schema, self.fmt)

    def keys(self, buckets: Sequence[int]) -> DataFrame:
        """Keys of earlier batches in these buckets: the last merge and what came after it."""
        merged = self.n // MERGE_EVERY * MERGE_EVERY
        parts = [(f"merged/upto={merged}", merged)] if merged else []
        parts += [(f"keys/batch={b}", b) for b in range(merged, self.n)]
        found = [_existing(self.spark, f"{self.path}/{p}", self.schema, self.fmt) for p, _ in parts]
        found = [df.filter(F.col("_bucket").isin(list(buckets))) for df in found]
        return reduce(DataFrame.unionByName, found, self.spark.createDataFrame([], self.schema))

    def merge(self, forget: Column) -> None:
        """Every MERGE_EVERY batches: all earlier keys in one table, but for those to forget."""
        if self.n and self.n % MERGE_EVERY == 0:
            before = Ledger(self.spark, self.path, self.n - 1, self.fmt)
            last = _existing(self.spark, f"{self.path}/keys/batch={self.n - 1}", self.schema, self.fmt)
            old = before.keys(range(BUCKETS)).unionByName(last).filter(~forget)
            writer = old.repartition("_bucket").write.format(self.fmt).mode("overwrite").partitionBy("_bucket")
            writer.save(f"{self.path}/merged/upto={self.n}")

    def add(self, fresh: DataFrame, newest: Column) -> None:
        """Writes the batch's keys, the bitmap with them, and the newest time."""
        keys = fresh.select(*_KEY, "_at", "_bucket").repartition("_bucket")
        writer = keys.write.format(self.fmt).mode("overwrite").partitionBy("_bucket")
        writer.save(f"{self.path}/keys/batch={self.n}")
        bits = fresh.select("_bucket", "_word", F.col("_bits").alias("_seen")).unionByName(self.bitmap())
        bits = bits.groupBy("_bucket", "_word").agg(F.bit_or("_seen").alias("_seen"))
        bits.coalesce(1).write.format(self.fmt).mode("overwrite").save(self._two("bitmap", self.n))  # BUCKETS * WORDS rows
        clock = self.spark.range(1).select(newest.cast("timestamp").alias("at"))
        clock.write.format(self.fmt).mode("overwrite").save(self._two("clock", self.n))


def fresh_rows(rows: DataFrame, ledger: Ledger) -> DataFrame:
    """``rows`` (one per key, with ``with_key``) whose key no earlier batch has accepted."""
    seen = (F.coalesce("_seen", F.lit(0)).bitwiseAND(F.col("_bits")) == F.col("_bits")).alias("_maybe")
    marked = rows.join(ledger.bitmap(), ["_bucket", "_word"], "left").select(*rows.columns, seen)
    maybe = marked.filter("_maybe").drop("_maybe")
    touched = [r[0] for r in maybe.select("_bucket").distinct().collect()]  # BUCKETS at most
    fresh = marked.filter("NOT _maybe").drop("_maybe")
    if touched:
        fresh = fresh.unionByName(maybe.join(ledger.keys(touched), _KEY, "left_anti"))
    return fresh


def dealt(batch: DataFrame) -> tuple[DataFrame, int]:
    """``batch`` cached in small parts, and over how many tasks to work on it.

    A source bounds its splits as they are stored; messages that compress well are many
    times that once they are read, and a task would go through all of it at every step.
    """
    parts = PARTS * max(1, batch.rdd.getNumPartitions())
    cached = batch.repartition(parts).persist()
    size = cached.agg(F.sum(F.octet_length("json_string"))).first()[0] or 0
    return cached, max(batch.sparkSession.sparkContext.defaultParallelism, math.ceil(size / TASK_BYTES))


def accounted(
    tagged: DataFrame,
    root: str,
    checkpoint: str,
    keys: Sequence[str],
    time_col: str,
    order: Sequence[str] = (),
    late_after: str | None = None,
    trigger: dict | None = None,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Rows of a feed, told apart by ``reject_reason``, into the tables of ``Accounts(root)``.

    Accepted is the first row per ``keys``; of repeats within a batch the first by
    ``order``. ``late_after`` is an interval such as "15 minutes": rows further behind
    the newest row of earlier batches go to ``late``. Rows without a time are never
    late. Without it the ledger keeps every key and no row is late.
    """
    accounts = Accounts(root)
    inner = ["json_string", "reject_reason"]

    def write(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        ledger = Ledger(spark, accounts.at("ledger"), n, fmt)
        cached, tasks = dealt(batch)
        batch = cached.coalesce(tasks)
        shuffled = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", str(max(int(shuffled), tasks)))
        try:
            newest = ledger.newest()
            behind = F.lit(False)
            if late_after and newest:
                edge = F.lit(newest) - F.expr(f"INTERVAL {late_after}")
                behind = F.coalesce(F.col(time_col) < edge, F.lit(False))
                ledger.merge(F.coalesce(F.col("_at") < edge, F.lit(False)))
            else:
                ledger.merge(F.lit(False))
            ok = F.col("reject_reason").isNull()
            outcome = F.when(~ok, "rejected").when(behind, "late").otherwise("in_time")
            rows = batch.withColumn("_outcome", outcome)
            good = rows.filter("_outcome = 'in_time'").drop("_outcome", "reject_reason")
            good = with_key(good, keys).withColumn("_at", F.col(time_col))
            fresh = fresh_rows(first_by(good, _KEY, [*order] or [time_col]), ledger).persist()
            try:
                own = [c for c in batch.columns if c not in inner]
                into_batch_folder(stamp(fresh.select(*own), "processed_at", "processing_date"), accounts.at("accepted"), n, fmt)
                late = rows.filter("_outcome = 'late'").select(*own, "json_string", F.lit("late").alias("reason"))
                into_batch_folder(stamp(late, "processed_at"), accounts.at("late"), n, fmt)
                rejects = rows.filter("_outcome = 'rejected'").select(*inner)
                into_batch_folder(stamp(rejects, "processed_at"), accounts.at("rejects"), n, fmt)
                accepted = fresh.count()
                counts = rows.groupBy("_outcome", "reject_reason").agg(F.count(F.lit(1)).alias("messages"), F.max(F.when(ok, F.col(time_col))).alias("at"))
                counts = counts.collect()  # one row for each outcome and reason
                in_time = sum(r.messages for r in counts if r._outcome == "in_time")
                found = [("accepted", "", accepted), ("repeat", "", in_time - accepted)]
                found += [(r._outcome, r.reject_reason or "", r.messages) for r in counts if r._outcome != "in_time"]
                into_batch_folder(spark.createDataFrame(found, "outcome string, reason string, messages long"), accounts.at("outcomes"), n, fmt)
                last = max([t for t in (newest, *(r.at for r in counts)) if t is not None], default=None)
                ledger.add(fresh, F.lit(last))
            finally:
                fresh.unpersist()
        except Exception as error:
            failed = [("failed", type(error).__name__, batch.count())]
            failed = spark.createDataFrame(failed, "outcome string, reason string, messages long")
            failed.write.format(fmt).mode("append").save(accounts.at("failed"))
            raise
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", shuffled)
            cached.unpersist()

    return batch_stream(tagged, write, checkpoint, trigger)
