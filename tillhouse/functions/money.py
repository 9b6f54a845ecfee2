"""Money is decimal in tables and whole cents in arithmetic; doubles appear only
in ratios and percentages.

Cents are 64-bit: Spark adds and divides those in generated code without an
object per value. A sum that leaves the range raises an error.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"
TOTAL = "decimal(18,2)"
# Factor by which share_cents splits an amount: the square root of the largest
# amount of decimal(12,2), so that no product leaves 64 bits.
SPLIT = 1_000_000


def as_money(value: Column) -> Column:
    return value.cast(MONEY)


def to_cents(amount: Column) -> Column:
    return (amount * F.lit(100)).cast("long")


def from_cents(cents: Column, kind: str = MONEY) -> Column:
    return (cents.cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast(kind)


def money_sum(amount: Column) -> Column:
    """SUM of a money column."""
    return from_cents(F.sum(to_cents(amount)), TOTAL)


def rounded_quotient(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator, rounded half away from zero; NULL for a zero denominator.

    Both sides are whole numbers, so there is no intermediate rounding.
    """
    d = F.nullif(denominator, F.lit(0))
    whole = F.call_function("div", F.abs(numerator) * 2 + F.abs(d), F.abs(d) * 2)
    return F.when((numerator < 0) != (d < 0), -whole).otherwise(whole)


def share_cents(amount: Column, part: Column, whole: Column) -> Column:
    """amount * part / whole, rounded once, half away from zero; NULL for a zero whole.

    All in cents, up to the range of decimal(12,2); ``part`` and ``whole`` are not
    negative. The product may need more than 64 bits, so ``part`` is split into
    high and low digits and the division is carried out in two steps, exactly.
    """
    w = F.nullif(whole, F.lit(0))
    size = F.abs(amount)
    high = size * F.call_function("div", part, F.lit(SPLIT))
    rest = high % w * SPLIT + size * (part % SPLIT)
    quotient = F.call_function("div", high, w) * SPLIT + F.call_function("div", rest, w)
    rounding = F.call_function("div", rest % w * 2, w)
    return (quotient + rounding) * F.signum(amount).cast("long")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double quotient, NULL for a zero denominator."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def percent_change(new: Column, old: Column) -> Column:
    """Change from old to new in percent; 0 when there is nothing to compare with."""
    n, o = new.cast("double"), old.cast("double")
    return F.when(o > 0, (n - o) / F.nullif(o, F.lit(0.0)) * 100).otherwise(F.lit(0.0))
