"""Text rules of the web layer, as column expressions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points ECMAScript counts as white space.
JS_SPACE_POINTS = [
    0x0009, 0x000A, 0x000B, 0x000C, 0x000D, 0x0020, 0x00A0, 0x1680,
    *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF,
]
JS_SPACE = "".join(map(chr, JS_SPACE_POINTS))


def js_trim(text: Column) -> Column:
    return F.btrim(text, F.lit(JS_SPACE))


def strip_angle_brackets(text: Column) -> Column:
    return F.translate(text, "<>", "")


def is_email(text: Column) -> Column:
    """something@something.something, no white space and only one @."""
    word = f"[^{JS_SPACE}@]+"
    return F.coalesce(text.rlike(rf"\A{word}@{word}\.{word}\z"), F.lit(False))


_PAD = f"[{JS_SPACE}]*"
_INTEGER = rf"\A{_PAD}([+-]?\d{{1,300}}|0[xX][0-9a-fA-F]+|0[oO][0-7]+|0[bB][01]+)?{_PAD}\z"
_DECIMAL = rf"\A{_PAD}[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?{_PAD}\z"


def as_number(text: Column) -> Column:
    """The number a decimal text stands for, padded or not; NULL for any other text."""
    return F.when(text.rlike(_DECIMAL), js_trim(text).try_cast("double"))


def is_whole_number(text: Column) -> Column:
    """Whether the text reads as a whole number: 7, 7.0, 7e2, 0x1f or blank, padded
    or not. Plain digits are decided by one pattern; only fractions and exponents
    are worked out."""
    number = as_number(text)
    whole = number % 1 == 0  # an infinite number leaves no remainder that is one
    return F.when(text.rlike(_INTEGER), True).otherwise(F.coalesce(whole, F.lit(False)))


def is_not_negative(text: Column) -> Column:
    """Whether a text that reads as a number is zero or more."""
    return F.when(text.contains("-"), as_number(text) >= 0).otherwise(True)


def contains_any(term: str, *columns: str) -> Column:
    """Case-insensitive substring search over several columns."""
    needle = term.lower()
    hits = [F.coalesce(F.lower(F.col(c)).contains(needle), F.lit(False)) for c in columns]
    return reduce(or_, hits)


def hour_label(hour: Column) -> Column:
    """9 -> '09:00'."""
    return F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":00"))
