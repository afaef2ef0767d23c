"""Small scalar helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a number in a message that may quote its numbers.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def ts(text: Column) -> Column:
    """Timestamp from ISO or ``yyyy-MM-dd HH:mm:ss`` text, NULL if malformed."""
    return F.try_to_timestamp(text)


def number(text: Column) -> Column:
    """Double from text, NULL where the text is not a number."""
    return F.when(text.rlike(NUMBER), F.trim(text).try_cast("double"))


def plain_number(text: Column) -> Column:
    """Number text without an exponent for everyday sizes (2.0E-4 as 0.0002).

    The point is moved in the text itself, so no digit is rounded or lost.
    """
    def part(group: int) -> Column:
        return F.regexp_extract(text, r"^\s*([+-]?)(\d*)\.?(\d*)[eE]([+-]?\d+)\s*$", group)

    digits = F.concat(part(2), part(3))
    point = F.length(part(2)) + part(4).try_cast("int")  # digits before the point
    padded = F.concat(F.repeat(F.lit("0"), F.greatest(F.lit(1) - point, F.lit(0))), digits)
    padded = F.concat(padded, F.repeat(F.lit("0"), F.greatest(point + 1 - F.length(digits), F.lit(0))))
    whole = F.greatest(point, F.lit(1))
    left = F.regexp_replace(F.substring(padded, F.lit(1), whole), "^0+(?=.)", "")
    right = F.regexp_replace(F.substring(padded, whole + 1, F.length(padded)), "(?<=.)0+$", "")
    sign = F.when(part(1) == "-", "-").otherwise("")
    size = F.abs(text.try_cast("double"))
    plain = F.concat(sign, left, F.lit("."), right)
    return F.when(text.rlike("[eE]") & size.between(1e-4, 1e15), plain).otherwise(text)


def or_default(value: Column, default: str) -> Column:
    return F.coalesce(value, F.lit(default))


def format_ts(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd HH:mm:ss")


def size_mb(size: Column) -> Column:
    return F.round(size / 1024 / 1024, 2)
