"""Orders and their items as tables stored side by side.

Both are partitioned by half-year of the order and bucketed by order, so the join of
items with their orders, and sums per order, need no shuffle; a range of days reads the
files of its half-years only. Items carry the time of their order for that. The bucket of
an order does not depend on the table, so rows are brought into place once, when written.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import all_of, half_years
from ..sinks import storage, with_half_year

OVERWRITE = "spark.sql.sources.partitionOverwriteMode"
TABLES = {
    "orders": (
        "id",
        "id BIGINT, branch_id BIGINT, created_at TIMESTAMP_NTZ, gross_amount DECIMAL(12,2), discount_amount DECIMAL(12,2)",
    ),
    "items": (
        "order_id",
        "order_id BIGINT, product_id BIGINT, quantity INT, unit_price DECIMAL(10,2), cost_price DECIMAL(10,2), "
        "created_at TIMESTAMP_NTZ",
    ),
}


@dataclass(frozen=True)
class OrderStore:
    """``folder`` holds the files, tables ``<name>_orders`` and ``<name>_items`` of the
    session's catalog describe them. ``buckets`` is fixed with the first write; take
    as many as keep a half-year's bucket at some hundred MB."""

    folder: str
    name: str = "stored"
    buckets: int = 64

    def table(self, kind: str) -> str:
        return f"{self.name}_{kind}"

    def open(self, spark: SparkSession) -> None:
        """Make the tables known to the session, with the partitions that are there."""
        for kind, (key, columns) in TABLES.items():
            path = f"{self.folder}/{kind}"
            storage.make_folder(spark, path)
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.table(kind)} ({columns}, year INT, half INT) USING parquet "
                f"PARTITIONED BY (year, half) CLUSTERED BY ({key}) SORTED BY ({key}) INTO {self.buckets} BUCKETS LOCATION '{path}'"
            )
            spark.sql(f"ALTER TABLE {self.table(kind)} RECOVER PARTITIONS")

    def write(self, orders: DataFrame, items: DataFrame) -> None:
        """Replace the half-years that ``orders`` has rows of, orders and items alike; items
        without an order belong to none and are not stored."""
        spark = orders.sparkSession
        timed = items.join(orders.select(F.col("id").alias("order_id"), "created_at"), "order_id")
        for kind, df in (("orders", orders), ("items", timed)):
            key = TABLES[kind][0]
            placed = with_half_year(df, "created_at").select(*spark.table(self.table(kind)).columns)
            # A task writes one bucket: one file a half-year.
            placed = placed.repartition(self.buckets, key).sortWithinPartitions("year", "half", key)
            before = spark.conf.get(OVERWRITE)
            spark.conf.set(OVERWRITE, "dynamic")  # a catalog table takes no writer option
            try:
                placed.write.mode("overwrite").insertInto(self.table(kind))
            finally:
                spark.conf.set(OVERWRITE, before)

    def _read(self, spark: SparkSession, kind: str, first: dt.date | None, last: dt.date | None) -> DataFrame:
        at = F.col("created_at")
        after = None if first is None else at >= F.lit(first).cast("timestamp_ntz")
        before = None if last is None else at < F.lit(last + dt.timedelta(days=1)).cast("timestamp_ntz")
        rows = spark.table(self.table(kind)).filter(all_of([after, before, half_years(first, last)]))
        return rows.drop("year", "half")

    def orders(self, spark: SparkSession, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
        """Orders, of a range of days if given."""
        return self._read(spark, "orders", first, last)

    def items(self, spark: SparkSession, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
        """Items of the orders of these days."""
        return self._read(spark, "items", first, last).drop("created_at")
