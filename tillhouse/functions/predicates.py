"""Optional filters. A condition that is not asked for never reaches the plan."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F


def all_of(conditions: Iterable[Column | None]) -> Column:
    """Conjunction of the conditions that are present; TRUE when there are none."""
    return reduce(and_, [c for c in conditions if c is not None], F.lit(True))


def optional_equal(column: str, value: object | None, *, zero_means_all: bool = False) -> Column | None:
    """column = value, or no condition when value is not supplied.

    The dashboards treat any falsy value, also id 0, as "not supplied".
    """
    if value is None or (zero_means_all and not value):
        return None
    return F.col(column) == F.lit(value)


def within_days(column: str, as_of: dt.datetime | dt.date, days: int) -> Column:
    """No older than ``days`` before ``as_of``; there is no upper bound.

    A date gives the day grain, a datetime the instant grain.
    """
    return F.col(column) >= F.lit(as_of - dt.timedelta(days=days))


def _half(day: dt.date) -> int:
    return day.year * 2 + (0 if day.month <= 6 else 1)


def half_years(first: dt.date | None, last: dt.date | None, year: str = "year", half: str = "half") -> Column | None:
    """The half-years, as partition columns, that a range of days lies in: what a bound on
    the day says about the partition, which Spark does not work out by itself."""
    number = F.col(year) * 2 + F.col(half) - 1
    if first is None and last is None:
        return None
    after = None if first is None else number >= _half(first)
    return all_of([after, None if last is None else number <= _half(last)])
