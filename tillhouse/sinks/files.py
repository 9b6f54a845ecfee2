"""Parquet tables."""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import delete, names


def _gathered(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bring rows of a partition together, for few files per partition. AQE splits
    a partition that is far larger than the others, so a busy day is written by
    several tasks."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    _gathered(df, partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)


def overwrite_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Truncate and reload. ``df`` must not read from ``path``."""
    writer = _gathered(df, partition_by).write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy(*partition_by).parquet(path)


def reload_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions that occur in ``df``, say the days just re-run;
    all others stay. ``df`` must not read from ``path``."""
    writer = _gathered(df, partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)


def _drop_emptied(df: DataFrame, path: str, column: str, wanted: Callable[[int], bool]) -> None:
    """Remove the partitions that were to be replaced and have no rows in ``df``."""
    spark = df.sparkSession
    filled = {r[0] for r in df.select(column).distinct().collect()}  # as many as partitions replaced
    for name in names(spark, path):
        key, _, value = name.partition("=")
        if key == column and value.isdigit() and wanted(int(value)) and int(value) not in filled:
            delete(spark, f"{path}/{name}")


def reload_range(df: DataFrame, path: str, column: str, first: int, last: int) -> None:
    """Replace the partitions ``column`` = first … last, whole numbers, by those of
    ``df``; one that has no rows any more is removed. All others stay. ``df`` must
    not read from ``path``."""
    own = df.filter(F.col(column).between(first, last))
    reload_partitions(own, path, [column])
    _drop_emptied(own, path, column, lambda v: first <= v <= last)


def reload_values(df: DataFrame, path: str, column: str, values: Collection[int]) -> None:
    """The same for the partitions ``column`` = one of ``values``."""
    own = df.filter(F.col(column).isin(list(values)))
    reload_partitions(own, path, [column])
    _drop_emptied(own, path, column, set(values).__contains__)


def with_half_year(df: DataFrame, time: str) -> DataFrame:
    """Add the ``year`` and ``half`` that order tables are partitioned by."""
    return df.withColumns({"year": F.year(time), "half": F.when(F.month(time) <= 6, 1).otherwise(2)})
