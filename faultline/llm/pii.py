"""Personal data in texts, by patterns, checksums and context, in Spark expressions.

Patterns propose spans, leftmost and without overlap for each kind; validators
(digit counts, octets, the Luhn and mod-97 checksums) drop or confirm them; the
words around a span move its score. Positions come from cutting the text at the
matches and adding up the lengths of the pieces, in code points.

The patterns are written so that Java neither recurses per repetition nor tries a
run of characters again from each of its places: repetitions are possessive, and a
match that may begin inside a run only begins at the run's start or where the last
match ended. Both find the same matches as the plain patterns beside them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound

#: Code points before and after a span in which context words count.
CONTEXT = 40
#: Lengths are added up in runs of this many, so that a text of many matches stays cheap.
RUN = 256


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    #: What a text needs to hold for the pattern to be tried.
    needs: str
    #: Score of a confirmed span without context, and the words that raise it.
    score: int
    context: str


# The kinds in the order of the output. In plain form the patterns are
# email  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
# ip     [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
# card   [0-9]([\x20-]?[0-9])+
# phone  \+[0-9][\x20().0-9-]+[0-9]
BASE = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
        80,
        r"(?i)e-?mail|contact|write to|reach|correo|courriel",
    ),
    Kind(
        "ip",
        r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        ".",
        50,
        r"(?i)\bip\b|address|server|host|ping|login|adresse",
    ),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?[0-9])++",
        "",
        70,
        r"(?i)card|visa|master|amex|credit|debit|pay|karte|carte|tarjeta",
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        "+",
        60,
        r"(?i)phone|call|tel|mobile|cell|fax|whatsapp|anruf|móvil",
    ),
)
ADDED = (
    Kind(
        "iban",
        r"(?:\G|(?<![A-Z0-9]))[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Z0-9])",
        "",
        70,
        r"(?i)iban|bank|account|konto|compte|cuenta|transfer",
    ),
)


def _digits(span: Column) -> Column:
    return F.regexp_replace(span, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Sum of the digits, every second from the right doubled with its digits added, is a multiple of ten."""
    doubled = "0246813579"

    def value(c: Column, i: Column) -> Column:
        plain = c.cast("int")
        return F.when(i % 2 == 1, F.substring(F.lit(doubled), plain + 1, F.lit(1)).cast("int")).otherwise(plain)

    each = F.transform(F.split(F.reverse(digits), ""), value)
    return F.aggregate(each, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def _mod97(span: Column) -> Column:
    """Letters read as 10 to 35, the first four signs moved to the end: 1 modulo 97."""
    plain = F.regexp_replace(span, " ", "")
    turned = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))

    def step(rest: Column, c: Column) -> Column:
        letter = c.rlike("[A-Z]")
        number = F.when(letter, F.ascii(c) - 55).otherwise(F.ascii(c) - 48)
        return (rest * F.when(letter, 100).otherwise(10) + number) % 97

    return F.aggregate(F.split(turned, ""), F.lit(0), lambda a, c: F.when(c == "", a).otherwise(step(a, c))) == 1


_OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"


def _valid(kind: str, span: Column) -> Column:
    if kind == "ip":
        return span.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        digits = _digits(span)
        return F.length(digits).between(13, 19) & F.when(F.length(digits) <= 19, _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(span)).between(9, 15)
    if kind == "iban":
        return F.length(F.regexp_replace(span, " ", "")).between(15, 34) & _mod97(span)
    return F.lit(True)


def _running(lengths: Column) -> Column:
    """Sums of all entries up to each, run by run: the sums of whole runs first, then inside."""
    zero = F.lit(0).cast("long")

    def total(values: Column) -> Column:
        return F.aggregate(values, zero, lambda a, x: a + x)

    def inside(values: Column, start: Column) -> Column:
        # the last entry is the sum so far; the first, the start, is dropped in the end
        grown = F.aggregate(values, F.array(start), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
        return F.slice(grown, 2, F.size(values))

    def summed(runs: Column) -> Column:
        def from_totals(totals: Column) -> Column:
            return F.flatten(F.transform(runs, lambda r, i: inside(r, total(F.slice(totals, 1, i)))))

        return bound(F.transform(runs, total), from_totals)

    last = F.floor((F.size(lengths) - 1) / RUN).cast("int")
    return bound(F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(lengths, i * RUN + 1, RUN)), summed)


def _spans(kind: Kind, text: Column, found: Column) -> Column:
    """Confirmed spans of one kind as an array of (start, end, score), given its matches."""

    def from_pieces(pieces: Column) -> Column:
        def lengths(m: Column, i: Column) -> Column:
            return F.array(F.length(F.get(pieces, i)).cast("long"), F.length(m).cast("long"))

        def from_ends(ends: Column) -> Column:
            def span(m: Column, i: Column) -> Column:
                end = F.get(ends, 2 * i + 1)
                before, after = F.get(pieces, i), F.get(pieces, i + 1)
                around = F.concat_ws(" ", F.right(before, F.lit(CONTEXT)), F.left(after, F.lit(CONTEXT)))
                score = F.lit(kind.score) + F.when(around.rlike(kind.context), 20).otherwise(0)
                fields = (end - F.length(m)).alias("start"), end.alias("end"), score.cast("int").alias("score")
                return F.when(_valid(kind.name, m), F.struct(*fields))

            return F.filter(F.transform(found, span), lambda s: s.isNotNull())

        # before the first match, the match, between it and the next, the next match, ...
        return bound(F.flatten(F.transform(found, lengths)), lambda each: bound(_running(each), from_ends))

    none = F.array().cast("array<struct<start: bigint, end: bigint, score: int>>")
    return F.when(F.size(found) > 0, bound(F.split(text, kind.pattern, -1), from_pieces)).otherwise(none)


def find(docs: DataFrame, kinds: tuple[Kind, ...] = BASE + ADDED) -> DataFrame:
    """doc_id, and per kind the array ``<kind>`` of (start, end, score); one row per row of ``docs``.

    start and end are code points of the whole text, end exclusive; score is 0 to
    100. Matches that fail their validator are dropped, with no other match tried in
    their place. Null and empty texts have no spans; rows that repeat are rows of
    their own; other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    none = F.array().cast("array<string>")
    for k in kinds:
        matches = F.regexp_extract_all("text", F.lit(k.pattern), F.lit(0))
        rows = rows.withColumn(f"_{k.name}", F.when(F.contains("text", F.lit(k.needs)), matches).otherwise(none) if k.needs else matches)
    return rows.select("doc_id", *(_spans(k, F.col("text"), F.col(f"_{k.name}")).alias(k.name) for k in kinds))


def listed(kinds: tuple[Kind, ...], form) -> Column:
    """All spans as text, by kind in the given order, then by start, comma-joined."""

    def of(kind: Kind) -> Column:
        return F.transform(kind.name, lambda s: form(F.lit(kind.name), s))

    return F.concat_ws(",", F.flatten(F.array(*map(of, kinds))))
