"""Keyed de-duplication that survives a key holding most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """One row per key: the smallest by ``order``, then by the remaining columns.

    An aggregate, not a window: copies collapse map-side before the shuffle, so
    a key with a third of all rows costs one row per input task.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = [o.alias(f"_o{i}") for i, o in enumerate(order)] + [F.col(c) for c in rest]
    first = F.min(F.struct(*ranked)).alias("_first")
    return df.groupBy(*keys).agg(first).select(*keys, *[F.col(f"_first.{c}").alias(c) for c in rest]).select(*df.columns)
