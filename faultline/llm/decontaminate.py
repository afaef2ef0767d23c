"""Benchmark decontamination by templates.

Texts become sequences of tokens in which numbers, names and units are typed
placeholders, so a question with other numbers or other names has the same
sequence. Windows of the sequence are hashed and joined with the windows of the
benchmark; what stood in the placeholders then has to fit together: one value in
the benchmark item stands for one value in the document throughout the passage.

Windows of the plain lower-cased tokens are hashed and joined beside them, since a
copy may be written in other capitals or hold hardly anything but numbers, and
then its template says too little. A passage is a leak by its template or by its
plain tokens.

A document's windows are many and the benchmark's few, so windows first pass a
Bloom filter of a fixed size made from the benchmark's hashes. The filter lets
every matching window through; the hash join that follows is exact.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import fresh, stage, text_hash

WINDOW = 5
#: A window of the template needs so many tokens that are no placeholders.
MIN_LITERALS = 2
#: A passage is a leak if it covers this share of the item's tokens ...
COVERAGE = 0.8
#: ... or so many of them in a row ...
RUN = 13
#: ... and this share of its placeholders is filled consistently.
CONSISTENT = 0.8
#: Places in the document and in the item may drift apart by less than this within a passage.
DRIFT = 16
#: The filter has 2 ** FILTER_BITS bits (512 KiB), whatever the benchmark's size.
FILTER_BITS = 22
#: Tokens remembered by a task.
CACHE = 500_000

# Words that count as numbers, and words that are units after a number.
NUMBER_WORDS = frozenset(
    """zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen
    seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million
    billion""".split()
)
UNITS = frozenset(
    """mm cm m km inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers
    kilometre kilometres g kg mg gram grams kilogram kilograms pound pounds lb lbs ounce ounces oz ton tons tonne
    tonnes l ml liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week
    weeks month months year years s min h hr hrs kmh mph hz khz mhz ghz w kw mw kwh v a ohm ohms n pa kpa bar j kj
    cal kcal c f k percent dollar dollars cent cents euro euros usd eur gbp degree degrees""".split()
)

#: Words come first, as most tokens are; they and numbers begin differently.
_TOKENS = re.compile(r"[^\W\d_]+|\d+(?:[.,]\d+)*|\w+|[.!?:;\n]+")
_PLAIN, _NUMBER, _CAPITAL, _UNIT, _STOP = range(5)
_FACTOR = 0x9E3779B97F4A7C15
_POWERS = np.array([pow(_FACTOR, k, 1 << 64) for k in range(WINDOW)], np.uint64)
_PLAIN_SIGNS = [np.uint64(xxh64_intdigest(f"<plain {size}>")) for size in range(WINDOW + 1)]
_PLACEHOLDERS = {k: np.uint64(xxh64_intdigest(f"<{k}>")) for k in (_NUMBER, _CAPITAL, _UNIT)}


def _kind(token: str) -> int:
    if token[0] in ".!?:;\n":
        return _STOP
    low = token.lower()
    if token[0].isdigit() or low in NUMBER_WORDS:
        return _NUMBER
    if token[0].isupper() and not token.isupper():  # capitals throughout are a way of writing, not a name
        return _CAPITAL
    return _UNIT if low in UNITS else _PLAIN


class _Tokens:
    """Numbers each token, remembering its hash and kind."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.hashes = np.zeros(1 << 16, np.uint64)
        self.kinds = np.zeros(1 << 16, np.int8)

    def _learn(self, tokens: list[str]) -> None:
        at = len(self.number)
        while at + len(tokens) > len(self.hashes):
            self.hashes = np.concatenate([self.hashes, np.zeros_like(self.hashes)])
            self.kinds = np.concatenate([self.kinds, np.zeros_like(self.kinds)])
        for at, t in enumerate(tokens, at):
            self.number[t] = at
            self.hashes[at] = xxh64_intdigest(t.lower().encode("utf-8", "replace"))
            self.kinds[at] = _kind(t)

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        if len(self.number) > CACHE:
            self.__init__()
        tokens = _TOKENS.findall(text)
        try:
            at = np.fromiter(map(self.number.__getitem__, tokens), np.int64, len(tokens))
        except KeyError:  # few texts have a token that none before had
            self._learn([t for t in set(tokens) if t not in self.number])
            at = np.fromiter(map(self.number.__getitem__, tokens), np.int64, len(tokens))
        return self.hashes[at], self.kinds[at]


def canonical(text: str, tokens: _Tokens | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(template, filler) hashes of a text's tokens; filler is 0 where the token stands for itself."""
    return _forms(text, tokens or _Tokens())[:2]


def _forms(text: str, tokens: _Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(template, filler, plain): the canonical form, and the hashes of the lower-cased tokens themselves.

    A capital letter makes a name unless the token begins a sentence or line; names
    in a row are one name. A unit is a unit only after a number.
    """
    hashes, kinds = tokens(text)
    stop = kinds == _STOP
    first = np.concatenate([[True], stop[:-1]])[: len(stop)]
    hashes, kinds, first = hashes[~stop], kinds[~stop].copy(), first[~stop]
    after_number = np.concatenate([[False], kinds[:-1] == _NUMBER])[: len(kinds)]
    kinds[(kinds == _UNIT) & ~after_number] = _PLAIN
    kinds[(kinds == _CAPITAL) & first] = _PLAIN
    name = kinds == _CAPITAL
    starts = ~(name & np.concatenate([[False], name[:-1]])[: len(name)])
    filler = np.where(kinds == _PLAIN, np.uint64(0), hashes)
    if len(filler):  # names in a row: one filler for all of them
        filler = np.add.reduceat(filler * np.uint64(3), np.flatnonzero(starts))
    template, kinds = hashes[starts].copy(), kinds[starts]
    for kind, placeholder in _PLACEHOLDERS.items():
        template[kinds == kind] = placeholder
    return template, filler, hashes


def _hashes(values: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the windows of ``size`` values."""
    n = max(0, len(values) - size + 1)
    hashes = np.zeros(n, np.uint64)
    mixed = values ^ (values >> np.uint64(29))
    for k in range(size):
        hashes += mixed[k : k + n] * _POWERS[k]
    return hashes ^ (hashes >> np.uint64(32))


def _windows(template: np.ndarray, filler: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Window hashes, and whether each window has enough literal tokens."""
    hashes = _hashes(template, WINDOW)
    literals = np.zeros(len(hashes), np.int8)
    for k in range(WINDOW):
        literals += filler[k : k + len(hashes)] == 0
    return hashes, literals >= MIN_LITERALS


def _plain_windows(plain: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Window hashes of plain tokens, and which to use: of those shorter than WINDOW, a whole item each, one of a kind."""
    hashes = _hashes(plain, size) ^ _PLAIN_SIGNS[size]
    use = np.full(len(hashes), size == WINDOW)
    if size < WINDOW:
        use[np.unique(hashes, return_index=True)[1]] = True
    return hashes, use


_ROWS = "plain boolean, pos int, window long, fillers array<long>, tokens int"


def _emit(bits: bytes | None = None, short: tuple[int, ...] = ()):
    """Window rows of each text; with ``bits``, those that pass the filter.

    Without ``bits`` the texts are items, and an item shorter than WINDOW is a plain
    window of its own size; ``short`` has the sizes of such items.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = None if bits is None else np.frombuffer(bits, np.uint64)
        tokens = _Tokens()
        for batch in batches:
            keys, parts = [], []
            for row, text in enumerate(batch.column("text")):
                template, filler, plain = _forms(text.as_py() or "", tokens)
                sizes = (WINDOW, *short) if words is not None or len(plain) >= WINDOW else (len(plain),)
                kinds = [(False, len(template), *_windows(template, filler))]
                kinds += [(True, len(plain), *_plain_windows(plain, size)) for size in sizes if size]
                for is_plain, size, window, ok in kinds:
                    if words is not None:
                        bit = window & np.uint64((1 << FILTER_BITS) - 1)
                        ok &= (words[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
                    at = np.flatnonzero(ok)
                    if len(at):
                        fillers = filler[:0] if is_plain else filler[at[:, None] + np.arange(WINDOW)].ravel()
                        n = np.full(len(at), 0 if is_plain else WINDOW)
                        keys.append(np.full(len(at), row))
                        parts.append((at, window[at], fillers, n, np.full(len(at), size), np.full(len(at), is_plain)))
            if not parts:
                continue
            at, window, fillers, n, sizes, is_plain = (np.concatenate(p) for p in zip(*parts))
            row = pa.array(np.concatenate(keys))
            ends = pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
            lists = pa.ListArray.from_arrays(ends, pa.array(fillers.view(np.int64)))
            columns = {c: batch.column(c).take(row) for c in batch.schema.names if c != "text"}
            columns |= {"plain": pa.array(is_plain), "pos": pa.array(at, pa.int32()), "window": pa.array(window.view(np.int64))}
            columns |= {"fillers": lists, "tokens": pa.array(sizes, pa.int32())}
            yield pa.RecordBatch.from_pydict(columns)

    return run


def _filter(benchmark: DataFrame) -> bytes:
    """Bitmap of the window hashes; at most 2 ** (FILTER_BITS - 6) words reach the driver."""
    bit = F.col("window").bitwiseAND(F.lit((1 << FILTER_BITS) - 1).cast("long"))
    mask = F.expr("shiftleft(1L, cast(bit & 63 as int))")
    rows = benchmark.select(bit.alias("bit")).groupBy((F.col("bit") / 64).cast("int").alias("at")).agg(F.bit_or(mask).alias("mask"))
    words = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for at, bits in rows.collect():
        words[at] = bits
    return words.tobytes()


def _verdict(rows: list[dict]) -> tuple[float, int, float]:
    """(coverage, longest run, consistent share) of one document's matches with one item."""
    covered = np.zeros(rows[0]["tokens"], bool)
    fills: dict[tuple[int, int], set[int]] = {}
    for r in rows:
        pos = r["item_pos"]
        covered[pos : pos + WINDOW] = True
        for k, (mine, theirs) in enumerate(zip(r["item_fillers"], r["fillers"])):
            if mine:
                fills.setdefault((mine, theirs), set()).add(pos + k)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.view(np.int8), [0]])))
    run = int((edges[1::2] - edges[::2]).max()) if len(edges) else 0
    best: dict[int, int] = {}
    for (mine, _), places in fills.items():
        best[mine] = max(best.get(mine, 0), len(places))
    total = sum(map(len, fills.values()))
    return float(covered.mean()), run, sum(best.values()) / total if total else 1.0


_KEYS = ["doc_id", "text_hash", "item_id", "plain", "place"]
_FOUND = "doc_id long, text_hash long, item_id long, coverage double, run int, consistent double"


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leaks among rows that come group by group; only one group is held at a time."""
    names = [column.split()[0] for column in _FOUND.split(", ")]
    rows = (r for b in batches for r in b.to_pylist())
    found: list[tuple] = []

    def made() -> pa.RecordBatch:
        kinds = [pa.int64()] * 3 + [pa.float64(), pa.int32(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], k) for i, k in enumerate(kinds)], names)

    for key, group in groupby(rows, key=itemgetter(*_KEYS)):
        coverage, run, consistent = _verdict(list(group))
        if (coverage >= COVERAGE or run >= RUN) and consistent >= CONSISTENT:
            found.append((*key[:3], coverage, run, consistent))
        if len(found) >= 10_000:
            yield made()
            found.clear()
    yield made()


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_hash, item_id, coverage, run, consistent): each document with each item it gives away.

    ``benchmark`` has item_id and text. Defined cases: null and empty texts hold
    nothing, nor does a text without a token; an item of fewer than five tokens is
    found where all of them stand in a row; repeated items are one item each, rows
    that repeat a document one result; null ids are kept as null. Both texts are read
    whole. Other columns are not read.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    items = stage(items.mapInArrow(_emit(), f"item_id long, {_ROWS}"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("text_hash"), "text")
    short = items.filter(F.col("plain") & (F.col("tokens") < WINDOW)).select("tokens").distinct()
    short = tuple(sorted(size for (size,) in short.collect()))  # four sizes at most
    rows = rows.mapInArrow(_emit(_filter(items), short), f"doc_id long, text_hash long, {_ROWS}").drop("tokens")
    items = items.withColumnsRenamed({"pos": "item_pos", "fillers": "item_fillers"})
    met = rows.join(items, ["window", "plain"])
    drift = F.col("pos") - F.col("item_pos")
    # two grids, shifted by half a step, so that a passage that drifts is whole in one of them
    grids = F.array(
        (F.floor(drift / DRIFT) * 2).cast("long"), (F.floor((drift + DRIFT // 2) / DRIFT) * 2 + 1).cast("long")
    )
    met = met.withColumn("place", F.explode(grids)).dropDuplicates(
        ["doc_id", "text_hash", "item_id", "plain", "place", "pos", "item_pos"]
    )
    met = stage(met)
    # with fewer windows a passage can be neither long nor covering
    enough = F.least(F.lit(RUN), F.ceil(F.max("tokens") * COVERAGE))
    long = met.groupBy(*_KEYS).agg((F.count_distinct("item_pos") * WINDOW >= enough).alias("long")).filter("long")
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in _KEYS]
    met = met.alias("a").join(long.alias("b"), same, "left_semi").select("a.*")
    found = met.repartition(*_KEYS).sortWithinPartitions(*_KEYS).mapInArrow(_judge, _FOUND)
    best = F.max(F.struct("coverage", "run", "consistent")).alias("best")
    return found.groupBy("doc_id", "text_hash", "item_id").agg(best).select(
        "doc_id", "text_hash", "item_id", "best.coverage", "best.run", "best.consistent"
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that give an item away; all other rows as they are."""
    key, id_, hash_ = (fresh(docs, c) for c in ("_text_hash", "_leak_id", "_leak_hash"))
    bad = leaks(docs, benchmark).select(F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_)).distinct()
    rows = docs.withColumn(key, text_hash())
    mine = F.col("doc_id").cast("long").eqNullSafe(F.col(id_)) & (F.col(key) == F.col(hash_))
    return rows.join(bad, mine, "left_anti").drop(key)
