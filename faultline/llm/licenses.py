"""License notices in texts by MinHash over overlapping windows, in Spark expressions.

Every length of template has windows of its own, a little longer than the template
and overlapping so that each passage of that length lies whole in one of them. A
window's MinHash bands retrieve templates of its length; what they retrieve counts
if enough of the template's shingles are exactly in the window.

Only windows around gate words are looked at. Gate words are chosen so that no part
of a text can hold enough of a template's shingles without holding one of them, so
this leaves no match out.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from math import ceil, floor, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_hash

SHINGLE = 5
CONTAINMENT = 0.8
#: MinHash values to a band.
ROWS = 2
#: A window that holds enough of a template shares a band with it at this probability at least.
RECALL = 0.999
#: Templates are literals of the plan and broadcast; more than this many are refused.
MOST_TEMPLATES = 1000

# Notices of well-known licenses.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related rights to this work"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("proprietary", "All rights reserved."),
)


@dataclass(frozen=True)
class _Template:
    license: str
    words: tuple[str, ...]

    @property
    def width(self) -> int:
        """Words to a shingle; a template of fewer words is one shingle."""
        return min(SHINGLE, len(self.words))

    @property
    def shingles(self) -> list[tuple[str, ...]]:
        return [self.words[i : i + self.width] for i in range(len(self.words) - self.width + 1)]

    @property
    def stride(self) -> int:
        return max(1, len(self.words) // 4)

    @property
    def window(self) -> int:
        return len(self.words) + self.stride - 1

    @property
    def least_similarity(self) -> float:
        """Jaccard similarity that a window with enough of the shingles has at least."""
        own, others = len(set(self.shingles)), self.window - self.width + 1
        shared = ceil(CONTAINMENT * own)
        return shared / (own + others - shared)


def _parsed(templates: Sequence[tuple[str, str]]) -> list[_Template]:
    if len(templates) > MOST_TEMPLATES:
        raise ValueError(f"at most {MOST_TEMPLATES} templates")
    found = {_Template(name, tuple(re.findall("[a-z0-9]+", text.lower()))) for name, text in templates}
    if any(not t.words for t in found):
        raise ValueError("a template has no words")
    return sorted(found, key=lambda t: (t.license, t.words))


def gate_words(templates: Sequence[_Template]) -> list[str]:
    """Words, long ones first, that are in so many shingles of each template that too few are without."""
    chosen: set[str] = set()
    for t in templates:
        spare = floor(len(set(t.shingles)) * (1 - CONTAINMENT) + 1e-9)
        for word in sorted(set(t.words), key=lambda w: (w not in chosen, -len(w), w)):
            if sum(bool(chosen.intersection(s)) for s in set(t.shingles)) > spare:
                break
            chosen.add(word)
    return sorted(chosen)


def bands(templates: Sequence[_Template]) -> int:
    """How many bands of ROWS values reach RECALL at the least similarity of any template."""
    least = min(t.least_similarity for t in templates)
    return ceil(log(1 - RECALL) / log(1 - least**ROWS)) if least < 1 else 1


def _shingles(words: Column, width: Column) -> Column:
    last = F.size(words) - width
    made = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.concat_ws(" ", F.slice(words, i + 1, width))))
    return F.when(last >= 0, F.array_distinct(made)).otherwise(F.array().cast("array<bigint>"))


def _bands(shingles: Column, n: int) -> Column:
    """Per band the hash of its number and its least hashed shingles; none without shingles."""

    def least(seed: Column) -> Column:
        return F.array_min(F.transform(shingles, lambda h: F.xxhash64(h, seed)))

    values = F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)), lambda b: F.xxhash64(b, *(least(b * ROWS + r) for r in range(ROWS)))
    )
    return F.when(F.size(shingles) > 0, values).otherwise(F.array().cast("array<bigint>"))


def _template_bands(spark, templates: Sequence[_Template], n: int) -> DataFrame:
    rows = F.array(
        *(
            F.struct(
                F.lit(t.license).alias("license"),
                F.array(*map(F.lit, t.words)).alias("words"),
                F.lit(len(t.words)).alias("length"),
                F.lit(t.width).alias("width"),
            )
            for t in templates
        )
    )
    table = spark.range(1).select(F.inline(rows)).withColumn("theirs", _shingles(F.col("words"), F.col("width")))
    return table.select("license", "length", "theirs", F.explode(_bands(F.col("theirs"), n)).alias("band"))


def scan(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """(doc_id, text_hash, license, containment, start, length): each document with each license it holds.

    ``start`` is the first word of the first window that holds the most of it,
    ``length`` the template's words. Defined cases: null and empty texts hold
    nothing; rows that repeat a document give one result; null ids stay null;
    other columns are not read. Texts are read whole.
    """
    known = _parsed(templates)
    gates, n = gate_words(known), bands(known)
    classes = sorted({(len(t.words), t.width, t.stride, t.window) for t in known})
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    low = rows.withColumn("low", F.lower("text"))
    low = low.filter(reduce(lambda a, b: a | b, (F.contains("low", F.lit(w)) for w in gates)))
    texts = low.select(
        "doc_id", text_hash().alias("text_hash"), F.regexp_extract_all("low", F.lit(r"[\p{L}\p{N}]+"), F.lit(0)).alias("words")
    )
    at = F.filter(
        F.transform("words", lambda w, i: F.when(w.isin(gates), i)), lambda i: i.isNotNull()
    )
    texts = texts.withColumn("at", at).filter(F.size("at") > 0)

    def windows(length: int, width: int, stride: int, window: int) -> Column:
        """All windows of the grid of this class that hold a gate word."""

        def around(p: Column) -> Column:
            first = F.greatest(F.lit(0), F.floor((p - window) / stride).cast("int") + 1)
            return F.sequence(first, F.floor(p / stride).cast("int"))

        starts = F.array_distinct(F.flatten(F.transform("at", around)))
        return F.transform(
            starts,
            lambda k: F.struct(
                F.lit(length).alias("length"),
                F.lit(width).alias("width"),
                (k * stride).alias("start"),
                F.slice("words", k * stride + 1, F.lit(window)).alias("words"),
            ),
        )

    seen = texts.select("doc_id", "text_hash", F.inline(F.concat(*(windows(*c) for c in classes))))
    seen = seen.withColumn("shingles", _shingles(F.col("words"), F.col("width"))).drop("words", "width")
    seen = seen.select("*", F.explode(_bands(F.col("shingles"), n)).alias("band"))
    met = seen.join(F.broadcast(_template_bands(docs.sparkSession, known, n)), ["length", "band"])
    held = F.size(F.array_intersect("shingles", "theirs")) / F.size("theirs")
    met = met.withColumn("containment", held).filter(F.col("containment") >= CONTAINMENT)
    best = F.max(F.struct("containment", "length", (-F.col("start")).alias("back"))).alias("best")
    found = met.groupBy("doc_id", "text_hash", "license").agg(best)
    return found.select(
        "doc_id", "text_hash", "license", "best.containment", (-F.col("best.back")).alias("start"), "best.length"
    )
