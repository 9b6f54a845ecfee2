"""NULL placement of the source database: last ascending, first descending.
Spark's own defaults are the opposite, so orderings are always spelled out."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pg_asc(c: Column | str) -> Column:
    return _col(c).asc_nulls_last()


def pg_desc(c: Column | str) -> Column:
    return _col(c).desc_nulls_first()
