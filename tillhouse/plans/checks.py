"""Data quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import duplicate_keys, orphans

MAX_ORDERS_PER_DAY = 10_000


def data_quality(stock: DataFrame, items: DataFrame, orders: DataFrame, orders_daily: DataFrame) -> DataFrame:
    """(check_name, status, details) of three checks, each a one-row aggregate."""
    n = F.col("n")
    count = F.count(F.lit(1)).alias("n")

    # Check names and texts as the quality report shows them.
    def outcome(df: DataFrame, name: str, failed: str, bad, bad_text, good_text) -> DataFrame:
        return df.select(
            F.lit(name).alias("check_name"),
            F.when(bad, failed).otherwise("PASSED").alias("status"),
            F.when(bad, bad_text).otherwise(good_text).alias("details"),
        )

    negative = stock.filter(F.col("stock_level") < 0).agg(count)
    lost = orphans(items, orders, "order_id").agg(count)
    busiest = orders_daily.agg(F.max("total_orders").alias("n"))
    return (
        outcome(
            negative, "Negative Stock Check", "FAILED", n > 0,
            F.format_string("Found %d items with negative stock.", n), F.lit("All stock levels >= 0."),
        )
        .unionByName(
            outcome(
                lost, "FK Integrity (Order Items)", "FAILED", n > 0,
                F.format_string("Found %d orphaned order items.", n), F.lit("All order items have valid parent orders."),
            )
        )
        .unionByName(
            outcome(
                busiest, "Abnormal Spike Check", "WARNING", n > MAX_ORDERS_PER_DAY,
                F.format_string("Max orders/day detected is %d, exceeds 10,000 threshold.", n),
                F.format_string("Max orders/day is %d, within normal limits.", F.coalesce(n, F.lit(0))),
            )
        )
    )


def uniqueness(df: DataFrame, keys: list[str], table: str) -> DataFrame:
    """One row saying how many keys of a table occur more than once."""
    return duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(f"Unique {table}({', '.join(keys)})").alias("check_name"),
        F.when(F.col("n") > 0, "FAILED").otherwise("PASSED").alias("status"),
        F.format_string("%d repeated keys.", "n").alias("details"),
    )
