"""Calendar expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def time_key(ts: Column) -> Column:
    """Smart day key YYYYMMDD."""
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def iso_weekday(ts: Column) -> Column:
    """Monday = 1 … Sunday = 7."""
    return F.weekday(ts) + 1


def day_name(ts: Column) -> Column:
    """English day name, blank-padded to nine characters."""
    return F.rpad(F.date_format(ts, "EEEE"), 9, " ")


def month_name(ts: Column) -> Column:
    """English month name, blank-padded to nine characters."""
    return F.rpad(F.date_format(ts, "MMMM"), 9, " ")
