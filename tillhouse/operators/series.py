"""Generated series and combinations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Slots per side of an all-combinations join: at least so many, and one more for every
# so many rows. The work is spread over the product of both numbers.
SLOTS = 16
ROWS_PER_SLOT = 4096


def date_spine(bounds: DataFrame, first: Column, last: Column, name: str = "date") -> DataFrame:
    """Every day from ``first`` to ``last``, for each row of ``bounds``."""
    days = F.explode(F.sequence(first.cast("date"), last.cast("date"), F.expr("interval 1 day")))
    return bounds.select(days.alias(name))


def numbered(df: DataFrame, count: Column, name: str) -> DataFrame:
    """Repeat each row count times, numbered from 1. Rows with no count vanish."""
    return df.filter(count >= 1).withColumn(name, F.explode(F.sequence(F.lit(1), count.cast("int"))))


def combinations(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every left row with every right row; the result is that long by definition.

    Rows of either side are dealt to slots and copied to all slots of the other
    side, and the pair of slots is an ordinary join key. A small side is
    broadcast by Spark, if its size allows; otherwise each task joins one slot
    of either side, and none holds a side whole.
    """

    def slots_of(df: DataFrame) -> Column:
        return df.agg(F.greatest(F.lit(SLOTS), F.ceil(F.count(F.lit(1)) / ROWS_PER_SLOT)).cast("int")).scalar()

    def dealt(df: DataFrame, own: str, slots: Column, other: str, copies: Column) -> DataFrame:
        slot = F.pmod(F.xxhash64(*df.columns), slots).cast("int")
        return df.withColumn(own, slot).withColumn(other, F.explode(F.sequence(F.lit(0), copies - 1)))

    a, b = slots_of(left), slots_of(right)
    return dealt(left, "_left", a, "_right", b).join(dealt(right, "_right", b, "_left", a), ["_left", "_right"]).drop("_left", "_right")
