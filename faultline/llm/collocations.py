"""Phrase collocations by Toivonen mining.

A sample of the documents proposes phrases: those that reach a lowered count there.
A full pass then counts every phrase whose two parts without the last and without the
first word were proposed: the proposals and their negative border, as far as it
occurs. A phrase of the border that turns out frequent was missed by the sample, and
longer ones may have been missed with it: it joins the proposals, and a second pass
counts it, what became a candidate by it, and what would become one by those in turn.
As a part of a phrase is at least as frequent as the phrase, all frequent phrases are
counted then, whatever the sample was.

Phrases are counted inside Arrow batches first, over numbers instead of words; what
goes to the shuffle are the distinct candidates of a batch. The border is large and
nearly all of it rare, so the first pass counts it by hash alone, which can only make
a count too large; all else is counted by its words. Nearly every row of a batch is a
group of its own there, so rows are dealt out by hash before they are summed. Whether a phrase was proposed is
asked of a bitmap of fixed size. It may say yes by mistake, which counts a phrase in
vain, never no.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import positions, stage

#: Words of a phrase, at most, and how often a candidate occurs, at least.
WORDS, FREQUENT = 4, 30
#: One document of so many is in the sample, and the count that proposes a phrase there.
SAMPLE, PROPOSED = 4, 6
#: A phrase goes if a longer one around it has this share, in percent, of its occurrences.
COVERED = 80
TOP = 2000
#: Bits of a filter of phrases (8 MiB), whatever the input.
FILTER_BITS = 26
#: Words counted together.
AT_ONCE = 1 << 19

_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = 64 - FILTER_BITS
#: Bits of a hash that phrases without a name are counted by: fewer bytes for each.
_HASHED = np.uint64((1 << 64) - (1 << 24))
#: Ends of pieces become line feeds, the other white space a space.
_PIECES = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n" * 9 + b" ")
_END = b"\n"


def words_of(text: bytes | None) -> list[bytes]:
    """The words of a text, A-Z in lower case, with a line feed wherever a piece ends."""
    pieces = (text or b"").lower().translate(_PIECES).replace(b"\n", b" \n ")
    return [w for w in pieces.split(b" ") if w]


def filter_of(phrases: DataFrame) -> np.ndarray:
    """Bitmap of the column ``hash``, in 2 ** (FILTER_BITS - 6) words: the most that reaches the driver."""
    at = F.shiftrightunsigned("hash", _SHIFT)
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(hash, {_SHIFT}) & 63 as int))")
    words = phrases.select(F.shiftright(at, 6).alias("at"), bit.alias("bit"))
    words = words.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    bits = np.zeros(1 << FILTER_BITS - 6, np.uint64)
    bits[words.column("at").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return bits


def _among(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes >> np.uint64(_SHIFT)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The number of each key among the distinct ones, where each of those comes first, and how often."""
    number, distinct = pd.factorize(keys)
    first = np.empty(len(distinct), np.int64)
    first[number[::-1]] = np.arange(len(keys))[::-1]
    return number, first, np.bincount(number, minlength=len(distinct))


class Documents:
    """Words of some documents, counted together."""

    def __init__(self):
        self.words, self.langs, self.runs = [_END], {}, []

    def add(self, lang: str, text: bytes | None) -> None:
        words = words_of(text)
        self.words += words
        self.words.append(_END)
        self.runs.append((self.langs.setdefault(lang, len(self.langs)), len(words) + 1))

    def counts(self, sizes: range, known: list[Callable], named: bool = True) -> Iterator[pa.RecordBatch]:
        """Rows of _COUNTS for the phrases of ``sizes`` words.

        ``known`` has what was known, ``(size, hashes) -> mask``, in the first pass and,
        in the second, then. A phrase is a candidate if its parts without an end word are
        known, a word always. The first pass counts candidates that are known themselves
        by their words and others by hash; the second counts those by their words that
        became known, and new candidates, which pass for known from then on, so that what
        they are parts of is counted with them. Without ``named`` all go by hash. Size 0
        has each lang's number of words.
        """
        coded = pa.array(self.words, pa.binary()).dictionary_encode()
        names, word = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        langs = pa.array(list(self.langs), pa.string())
        runs = np.array(self.runs, np.int64).reshape(-1, 2)
        lang = np.concatenate([[0], np.repeat(runs[:, 0], runs[:, 1])])
        at = np.flatnonzero(word != names.index(_END).as_py())  # where phrases of the present size start
        if 0 in sizes:
            total = np.bincount(lang[at], minlength=len(langs))
            yield self._rows(np.zeros(len(langs), np.uint64), total, langs, pa.array([""] * len(langs), pa.string()))
        of_word = np.array([xxh64_intdigest(w) for w in names.to_pylist()], np.uint64)
        of_lang = np.array([xxh64_intdigest(x, 1) for x in langs.to_pylist()] or [0], np.uint64)
        place = np.full(len(word) + 1, -1)  # by start: the number of the phrase there, if it is known
        second = len(known) > 1
        for size in range(1, max(sizes) + 1):
            if size == 1:
                number, first, n = _numbered(lang[at] << 32 | word[at])
                new = _mixed(of_word[word[at[first]]] + of_lang[lang[at[first]]])
                asked = np.ones(len(n), bool)  # in the second pass: whether it was a candidate in the first
            else:
                at = np.flatnonzero((place[:-1] >= 0) & (place[1:] >= 0))
                left, right = place[at], place[at + 1]
                number, first, n = _numbered(left << 32 | right)
                left, right = left[first], right[first]
                new = _mixed(hashes[left] * _MIX + hashes[right])
                asked = earlier[left] & earlier[right] if second else None
            if not len(at):
                return
            hashes, held = new, known[-1](size, new)
            if second:
                held, earlier = held | ~asked, asked & known[0](size, new)
            if size in sizes:
                if second:
                    by_word, by_hash = held & ~earlier, np.zeros(len(n), bool)
                else:
                    by_word, by_hash = (held, ~held) if named else (np.zeros(len(n), bool), np.ones(len(n), bool))
                if by_word.any():
                    starts = at[first[by_word]]
                    each = [names.take(pa.array(word[starts + k])) for k in range(size)]
                    phrases = pc.binary_join_element_wise(*each, pa.scalar(b" ", pa.binary())).cast(pa.string())
                    yield self._rows(new[by_word], n[by_word], langs.take(pa.array(lang[starts])), phrases)
                if by_hash.any():
                    yield self._rows(new[by_hash] & _HASHED, n[by_hash])
            place[:] = -1
            place[at] = np.where(held[number], number, -1)

    @staticmethod
    def _rows(hashes: np.ndarray, n: np.ndarray, langs: pa.Array | None = None, phrases: pa.Array | None = None) -> pa.RecordBatch:
        names = pa.nulls(len(n), pa.string()) if phrases is None else pc.binary_join_element_wise(langs, phrases, "\n")
        return pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), names, pa.array(n.astype(np.int64))], _NAMES)


#: A name is a lang, a line feed and a phrase; what is counted by hash has none.
_COUNTS, _NAMES = "hash long, name string, n long", ["hash", "name", "n"]


def counts(docs: DataFrame, sizes: range, filters: list[np.ndarray], named: bool = True) -> DataFrame:
    """(hash, lang, size, phrase, n) of the candidates in ``docs`` (lang, text), see ``Documents.counts``.

    The first pass knows what is in the first of ``filters``, the second what is in
    either. Sizes that no filter has been made for are known: all without a filter, and
    without ``named`` those of ``sizes``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def within(maps: np.ndarray | None) -> Callable:
            def known(size: int, hashes: np.ndarray) -> np.ndarray:
                if maps is None or not named and size in sizes:
                    return np.ones(len(hashes), bool)
                return _among(maps, hashes)

            return known

        how = sizes, [within(f) for f in filters or [None]], named
        held = Documents()
        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").cast(pa.binary())):
                held.add(lang, text.as_py())
                if len(held.words) >= AT_ONCE:
                    yield from held.counts(*how)
                    held = Documents()
        yield from held.counts(*how)

    each = docs.mapInArrow(run, _COUNTS).repartition("hash")
    each = each.groupBy("hash", "name").agg(F.sum("n").alias("n")).withColumn("phrase", F.substring_index("name", "\n", -1))
    lang = F.expr("left(name, length(name) - length(phrase) - 1)").alias("lang")
    size = F.when(F.col("phrase") == "", 0).otherwise(F.expr("length(phrase) - length(replace(phrase, ' ', '')) + 1"))
    return each.select("hash", lang, F.when(F.col("phrase").isNotNull(), size).alias("size"), "phrase", "n")


def frequent(docs: DataFrame, least: int = FREQUENT, sample: int = SAMPLE, proposed: int = PROPOSED) -> DataFrame:
    """(lang, size, phrase, n): every phrase of up to WORDS words that occurs ``least`` times, by lang.

    Size 0 has the number of all words. ``docs`` is (lang, text, chance); a document
    is in the sample where its long ``chance`` is divisible by ``sample``.
    """
    whole = docs.select("lang", "text")
    part = docs.filter(F.col("chance") % sample == 0).select("lang", "text")
    enough = F.col("n") >= proposed
    short = filter_of(counts(part, range(1, 3), [], False).filter(enough))
    longer = filter_of(counts(part, range(3, WORDS + 1), [short], False).filter(enough))
    first = short | longer
    new = stage(counts(whole, range(WORDS + 1), [first]).filter((F.col("n") >= least) | (F.col("size") == 0)))
    found = new.filter(F.col("phrase").isNotNull()).select("lang", "size", "phrase", "n")
    missed = new.filter(F.col("phrase").isNull())
    if missed.isEmpty():
        return found
    more = counts(whole, range(1, WORDS + 1), [first, first | filter_of(missed)]).filter(F.col("n") >= least)
    return found.unionAll(stage(more).select("lang", "size", "phrase", "n"))


def _from(phrase: Column, word: Column | int) -> Column:
    """The phrase from its ``word``-th word on, counted from 0."""
    return F.array_join(F.slice(F.split(phrase, " "), F.lit(word) + 1, WORDS), " ")


def scored(found: DataFrame, covered: int = COVERED) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the candidates that no longer phrase covers.

    ``found`` is what ``frequent`` gives.
    """
    totals = found.filter("size = 0").select("lang", F.col("n").alias("words"))
    ones = found.filter("size > 0").select("lang", "phrase", "n")
    many = found.filter("size > 1")
    cut = F.posexplode(F.sequence(F.lit(1), F.col("size") - 1)).alias("_at", "k")
    cuts = many.select("lang", "phrase", F.col("n").alias("a"), cut)
    cuts = cuts.withColumn("first", F.expr("substring_index(phrase, ' ', k)")).withColumn("rest", _from(F.col("phrase"), F.col("k")))
    left = ones.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = ones.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    cuts = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    score = F.expr("(cast(a as decimal(20,0)) * 2000000) div (cast(l as decimal(20,0)) + r)")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")
    scores = cuts.groupBy("lang", "phrase", "a").agg(best)
    spans = [(size, start, n) for size in range(3, WORDS + 1) for n in range(2, size) for start in range(size - n + 1)]
    inner = [
        F.when(F.col("size") == size, F.substring_index(_from(F.col("phrase"), start), " ", n)) for size, start, n in spans
    ]
    around = many.filter("size > 2").select("lang", F.explode(F.array_distinct(F.array_compact(F.array(*inner)))).alias("phrase"), "n")
    around = around.groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    kept = scores.join(around, ["lang", "phrase"], "left").filter(F.expr(f"coalesce(100 * longer < {covered} * a, true)"))
    return kept.join(totals, "lang").select(
        "lang", "phrase", "a", "best.l", "best.r", F.col("words").alias("n"), F.col("best.score").cast("long").alias("score")
    )


def ranked(phrases: DataFrame, top: int = TOP) -> DataFrame:
    """``phrases`` with their rank within their lang, the first ``top`` of each.

    Ranks come from the place in one order of all, so no lang is one task's work.
    """
    placed = stage(positions(phrases, F.col("lang"), F.desc("score"), F.desc("a"), F.col("phrase")))
    starts = placed.groupBy("lang").agg(F.min("position").alias("_start"))
    rank = (F.col("position") - F.col("_start") + 1).alias("rank")
    return placed.join(starts, "lang").select("lang", rank, "phrase", "a", "l", "r", "n", "score").filter(F.col("rank") <= top)


def collocations(docs: DataFrame) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the phrases of each lang whose words keep together most.

    Defined cases: a null text is empty, a null lang is ``und``; empty texts add
    nothing; repeated rows count as often as they are there; no documents, or none
    with a frequent phrase, give no rows. Only doc_id, lang and text are read.
    """
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")
    chance = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)).alias("chance")
    return ranked(scored(frequent(docs.select(lang, "text", chance))))
