"""Planned order volume per day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import iso_weekday
from ..operators import date_spine

WEEKEND_FACTOR = 1.5


def date_volume_plan(history: DataFrame, first: Column, last: Column, base: Column) -> DataFrame:
    """One row per day between ``first`` and ``last`` with the orders to expect:
    ``base``, half as many again at weekends. ``history`` is the one-row frame
    the three expressions refer to."""
    days = date_spine(history.withColumns({"_first": first, "_last": last}), F.col("_first"), F.col("_last"), "d")
    level = history.select(base.cast("long")).scalar()
    weekend = iso_weekday(F.col("d")).isin(6, 7)
    return days.select(
        "d",
        F.when(weekend, F.round(level * F.lit(WEEKEND_FACTOR).cast("decimal(2,1)"))).otherwise(level).cast("long").alias("num_orders"),
    )
