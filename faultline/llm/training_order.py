"""Token records in training order.

Documents become token ids, cut into sequences of a fixed length. Sequences are
numbered in the order of their documents' ids; a keyed Feistel permutation of that
number, walked along its cycle until it falls below the number of sequences, is the
sequence's global slot. Slots are dealt out by range: shard s holds the slots from
s * SHARD on, and a slot's record begins at (slot % SHARD) * stride of its shard,
so a reader resumes at any slot by arithmetic alone.

A record is the doc_id (8 bytes), the sequence's number in the document and its
count of tokens (4 each), then SEQUENCE token ids of 2 bytes, all little-endian and
filled up with zero bytes.
"""

from __future__ import annotations

import base64
import os
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage, staged_zstd, text_hash

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The id after the vocabulary's last ends each document.
END = 50_256
SEQUENCE = 512
SHARD = 4096
KEY = 0x5EED
ROUNDS = 6
HEADER = "<qii"
HEADER_BYTES = struct.calcsize(HEADER)

# Fixed value: the pattern that goes with the vocabulary's merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def stride(sequence: int = SEQUENCE) -> int:
    return HEADER_BYTES + 2 * sequence


def _encoding(vocabulary: str) -> tiktoken.Encoding:
    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines)}
    return tiktoken.Encoding("corpus", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def tokenized(docs: DataFrame, vocabulary: str = VOCABULARY, sequence: int = SEQUENCE) -> DataFrame:
    """(doc_id, ids, sequences, before, place) in order of doc_id and text hash, nulls first.

    ids end with END, 2 bytes each; ``before`` counts the sequences of the rows
    before in the partition ``place``. The vocabulary file has to be on every
    executor, like the tokenizer itself.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(vocabulary).encode_ordinary
        before = 0
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                ids = [np.array([*encode(t.as_py() or ""), END], np.uint16).tobytes() for t in part.column("text")]
                counts = np.array([-(-len(x) // (2 * sequence)) for x in ids], np.int64)
                ends = before + np.cumsum(counts)
                columns = [part.column("doc_id"), pa.array(ids, pa.binary()), pa.array(counts), pa.array(ends - counts)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "sequences", "before"])
                before = int(ends[-1])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("_hash"), "text")
    rows = rows.repartitionByRange("doc_id", "_hash").sortWithinPartitions("doc_id", "_hash").drop("_hash")
    rows = rows.mapInArrow(run, "doc_id long, ids binary, sequences long, before long")
    return rows.withColumn("place", F.spark_partition_id())


def _mixed(x: np.ndarray, key: int) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on all of x and key."""
    x = x + np.uint64(key)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(numbers: np.ndarray, size: int, key: int = KEY) -> np.ndarray:
    """A keyed permutation of range(size), for any of its numbers.

    A Feistel network permutes the next power of four; a number that lands at
    ``size`` or above goes through it again until it doesn't. As the whole network
    is a permutation, so is that, and a walk takes less than four steps on average.
    """
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    out = numbers.astype(np.uint64)
    walk = np.ones(len(out), bool)
    while walk.any():
        left, right = out[walk] >> np.uint64(half), out[walk] & mask
        for i in range(ROUNDS):
            round_key = (key * 0x9E3779B97F4A7C15 + i * 0xD1B54A32D192ED03) % (1 << 64)
            left, right = right, left ^ (_mixed(right, round_key) & mask)
        out[walk] = left << np.uint64(half) | right
        walk = out >= np.uint64(size)
    return out.astype(np.int64)


def _sequences(total: int, sequence: int, key: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                rows = b.slice(at, 256).to_pylist()
                parts = [(r, p) for r in rows for p in range(r["sequences"])]
                slots = permuted(np.array([r["first"] + p for r, p in parts], np.int64), total, key)
                records = []
                for r, p in parts:
                    ids = r["ids"][2 * sequence * p : 2 * sequence * (p + 1)]
                    records.append(struct.pack(HEADER, -1 if r["doc_id"] is None else r["doc_id"], p, len(ids) // 2) + ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(slots),
                        pa.array([r["doc_id"] for r, _ in parts], pa.int64()),
                        pa.array([p for _, p in parts], pa.int32()),
                        pa.array(records, pa.binary()),
                    ],
                    ["slot", "doc_id", "part", "record"],
                )

    return run


def training_order(
    docs: DataFrame, vocabulary: str = VOCABULARY, sequence: int = SEQUENCE, shard: int = SHARD, key: int = KEY
) -> DataFrame:
    """(slot, shard, offset, doc_id, part, tokens, record), one row per sequence, in shards by range of slot.

    Every partition holds whole shards in order of slot, every record has
    ``stride(sequence)`` bytes. Defined cases: a null or empty text is one sequence
    of END alone; a null doc_id is written as -1 and comes first in the numbering;
    rows that repeat a document have sequences of their own; no documents give no
    rows. Only doc_id and text are read.
    """
    rows = staged_zstd(tokenized(docs, vocabulary, sequence))
    counts = stage(rows.groupBy("place").agg(F.sum("sequences").alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    ahead = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("place", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("start"))
    # one row per partition of the staged table, whatever the input's size
    rows = rows.join(F.broadcast(starts), "place")
    rows = rows.select("doc_id", "ids", "sequences", (F.col("start") + F.col("before")).alias("first"))
    records = rows.mapInArrow(_sequences(total, sequence, key), "slot long, doc_id long, part int, record binary")
    records = records.withColumn("shard", F.floor(F.col("slot") / shard))
    shards = max(1, -(-total // shard))
    parts = min(shards, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = records.repartitionById(parts, (F.col("shard") * parts / shards).cast("int")).sortWithinPartitions("slot")
    size = stride(sequence)
    return dealt.select(
        "slot",
        "shard",
        ((F.col("slot") % shard) * size).alias("offset"),
        "doc_id",
        "part",
        ((F.length("record") - HEADER_BYTES) / 2).cast("int").alias("tokens"),
        F.rpad("record", F.lit(size), F.lit(b"\0")).alias("record"),
    )


def write_shards(ordered: DataFrame, folder: str, suffix: str = ".bin") -> DataFrame:
    """Write each shard of ``ordered`` as one file of fixed-stride records; (shard, records, path).

    ``folder`` is a URI or path that all executors share. A file appears under its
    name only when it is whole, so a task that is lost or run twice leaves the same
    files behind.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{os.path.abspath(folder)}")
        store.create_dir(base, recursive=True)
        shard, out, part, count, done = None, None, "", 0, []

        def close() -> None:
            out.close()
            path = f"{base}/shard-{shard:08d}{suffix}"
            store.move(part, path)
            done.append((shard, count, path))

        for b in batches:
            for s, record in zip(b.column("shard").to_pylist(), b.column("record")):
                if s != shard:
                    if out is not None:
                        close()
                    shard, part, count = s, f"{base}/.{uuid.uuid4().hex}", 0
                    out = store.open_output_stream(part)
                out.write(record.as_buffer())
                count += 1
        if out is not None:
            close()
        columns = [pa.array([d[i] for d in done], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.string()))]
        yield pa.RecordBatch.from_arrays(columns, ["shard", "records", "path"])

    return ordered.select("shard", "record").mapInArrow(run, "shard long, records long, path string")


def read_from(folder: str, slot: int, sequence: int = SEQUENCE, shard: int = SHARD) -> Iterator[tuple[int, np.ndarray]]:
    """(doc_id, token ids) of the records from ``slot`` on, in training order."""
    store, base = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{os.path.abspath(folder)}")
    size, at = stride(sequence), slot % shard
    for number in range(slot // shard, 1 << 62):
        path = f"{base}/shard-{number:08d}.bin"
        if store.get_file_info(path).type == fs.FileType.NotFound:
            return
        with store.open_input_file(path) as source:
            source.seek(at * size)
            while record := source.read(size):
                doc_id, _, tokens = struct.unpack_from(HEADER, record)
                yield doc_id, np.frombuffer(record, np.uint16, tokens, HEADER_BYTES)
        at = 0
