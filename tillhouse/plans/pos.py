"""Point-of-sale events: cleaning, staging and normalization."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import as_money
from ..operators import keep_first
from ..schemas import POS_EVENT


def parse_events(lines: DataFrame) -> DataFrame:
    """JSON text in ``value`` -> typed event columns. A malformed line gives a row of NULLs."""
    return lines.select(F.from_json("value", POS_EVENT).alias("event")).select("event.*")


def malformed(lines: DataFrame) -> DataFrame:
    """Lines that are no POS event: not JSON, or without a transaction id."""
    event = F.from_json("value", POS_EVENT)
    return lines.filter(event.getField("transaction_id").isNull()).select("value")


def clean(raw: DataFrame) -> DataFrame:
    """De-duplicated, priced events with their total and day.

    Of several rows with one transaction id the earliest survives; ties go to
    the smallest remaining columns. The price filter comes after that choice,
    so an unpriced survivor hides a priced copy. Unreadable times become NULL.
    """
    unique = keep_first(raw, ["transaction_id"], [F.col("timestamp").isNull(), F.col("timestamp")])
    priced = unique.filter(F.col("unit_price") > 0)
    at = F.col("timestamp").try_cast("timestamp_ntz")
    return (
        priced.withColumn("total_price", as_money(F.col("unit_price").cast("decimal(10,2)") * F.col("quantity")))
        .withColumn("timestamp", at)
        .withColumn("date", F.to_date("timestamp"))
    )


def daily_sales(cleaned: DataFrame) -> DataFrame:
    return cleaned.groupBy("date", "branch_id", "product_id").agg(
        F.sum("quantity").alias("daily_quantity"),
        F.sum("total_price").alias("daily_revenue"),
        F.count("transaction_id").alias("transaction_count"),
    )


def stage(raw: DataFrame) -> DataFrame:
    """Rows of the staging table: one per transaction id, typed."""
    unique = keep_first(raw, ["transaction_id"], [F.col("timestamp").isNull(), F.col("timestamp")])
    return unique.select(
        "transaction_id",
        "branch_id",
        "product_id",
        "quantity",
        F.col("unit_price").cast("decimal(10,2)").alias("unit_price"),
        F.col("timestamp").try_cast("timestamp_ntz").alias("event_ts"),
    )


def normalize(staged: DataFrame) -> Mapping[str, DataFrame]:
    """Order headers and items of staged events. Both carry the transaction id,
    so no generated order number has to flow from one to the other."""
    gross = (F.col("unit_price") * F.col("quantity")).cast("decimal(10,2)")
    orders = staged.select(
        F.col("transaction_id").alias("order_id"),
        "branch_id",
        gross.alias("gross_amount"),
        F.lit(0).cast("decimal(10,2)").alias("discount_amount"),
        F.col("event_ts").alias("created_at"),
    )
    items = staged.select(
        F.col("transaction_id").alias("order_id"), "branch_id", "product_id", "quantity", "unit_price"
    )
    return {"orders": orders, "order_items": items}


def normalized_rows(staged: DataFrame) -> DataFrame:
    """Header and item of each staged event side by side; one item per order, so no join."""
    gross = (F.col("unit_price") * F.col("quantity")).cast("decimal(10,2)")
    return staged.select(
        F.col("transaction_id").alias("order_id"),
        "branch_id",
        gross.alias("gross_amount"),
        F.lit(0).cast("decimal(10,2)").alias("discount_amount"),
        F.col("event_ts").alias("created_at"),
        "product_id",
        "quantity",
        "unit_price",
    )


def consumption(items: DataFrame) -> DataFrame:
    """Units taken per (branch, product)."""
    return items.groupBy("branch_id", "product_id").agg(F.sum("quantity").alias("total_qty"))


def spike_alerts(events: DataFrame, time: str = "event_ts", window: str = "5 seconds", threshold: int = 20) -> DataFrame:
    """Branches that sold ``threshold`` units or more within one window.

    The same on a batch and on a stream (which needs a watermark on ``time``).
    """
    return (
        events.groupBy(F.window(time, window).alias("_w"), "branch_id")
        .agg(F.sum("quantity").alias("units"))
        .filter(F.col("units") >= threshold)
        .select(F.col("_w.start").alias("window_start"), "branch_id", "units")
    )
