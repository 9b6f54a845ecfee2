"""Relational sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_jdbc(
    df: DataFrame, url: str, table: str, properties: dict[str, str],
    mode: str = "append", connections: int = 16, batch_rows: int = 10_000,
) -> None:
    """Write over JDBC with at most ``connections`` at a time. ``overwrite`` empties
    the table and keeps its definition, keys and grants. Errors are raised:
    a stream that swallowed them would move on without the rows."""
    (
        df.write.mode(mode)
        .option("truncate", "true")
        .option("batchsize", batch_rows)
        .option("numPartitions", connections)
        .jdbc(url, table, properties=properties)
    )
