"""Pages of a long list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def page(df: DataFrame, order: Sequence[Column], limit: int, offset: int = 0) -> DataFrame:
    """Rows offset … offset + limit. Tasks send on only their own first rows;
    ``order`` must end in a unique column for pages not to overlap."""
    ordered = df.orderBy(*order)
    return (ordered.offset(offset) if offset else ordered).limit(limit)


def page_after(df: DataFrame, time: str, key: str, limit: int, last: tuple[object, object] | None = None) -> DataFrame:
    """Newest-first page by position instead of offset: the cost of a deep page
    is that of the first one. ``last`` is (time, key) of the row seen last."""
    if last is not None:
        seen_time, seen_key = F.lit(last[0]), F.lit(last[1])
        df = df.filter((F.col(time) < seen_time) | ((F.col(time) == seen_time) & (F.col(key) < seen_key)))
    return df.orderBy(F.col(time).desc_nulls_last(), F.col(key).desc_nulls_last()).limit(limit)


def newest_first(rows: DataFrame, time: str, key: str) -> DataFrame:
    """The few rows of a page in order, after joins that do not keep it. They are sorted
    in one row: a sort over joins of a limited frame does not survive adaptive planning."""
    row = F.struct(F.col(time).isNull(), F.col(time), F.col(key), F.struct(*rows.columns).alias("row"))
    listed = rows.agg(F.sort_array(F.collect_list(row), asc=False).alias("rows"))
    return listed.select(F.explode("rows").alias("r")).select("r.row.*")


def page_info(df: DataFrame, number: int, size: int) -> DataFrame:
    """page, limit, total, pages — one row."""
    return df.agg(F.count(F.lit(1)).alias("total")).select(
        F.lit(number).cast("long").alias("page"),
        F.lit(size).cast("long").alias("limit"),
        "total",
        F.ceil(F.col("total") / F.lit(size)).cast("long").alias("pages"),
    )
