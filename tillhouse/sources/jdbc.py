"""Relational sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 64,
) -> DataFrame:
    """Scan a table over JDBC, in ``partitions`` key ranges when a whole-number
    column and its bounds are given. Filters and column lists are pushed down."""
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=properties)
    if bounds is None:
        raise ValueError("a partition column needs its lower and upper bound")
    return spark.read.jdbc(
        url,
        table,
        column=partition_column,
        lowerBound=bounds[0],
        upperBound=bounds[1],
        numPartitions=partitions,
        properties=properties,
    )
