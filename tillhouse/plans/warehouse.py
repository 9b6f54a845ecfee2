"""The star schema as stored tables.

Dimensions are kept in numbered loads, so a load that fails half-way leaves the
one before intact. Facts are partitioned by day: a day filter reads only that
day, and a re-run replaces only the days it touches.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks import overwrite_table, reload_range, reload_values
from ..sinks.storage import delete
from . import deltas, star
from .dashboard import day_key

DIM_BRANCH = "branch_key long, branch_id long, name string, valid_from date, is_current boolean"
DIM_PRODUCT = "product_key long, product_id long, name string, category string, valid_from date, is_current boolean"
DIM_TIME = (
    "time_key int, full_date date, day_of_week int, day_name string, month int, month_name string, quarter int, "
    "year int, is_weekend boolean"
)
DIMENSIONS = {"dim_branch": DIM_BRANCH, "dim_product": DIM_PRODUCT, "dim_time": DIM_TIME}
FACTS = {
    "fact_sales": "time_key int, branch_key long, product_key long, order_id long, quantity int, gross_amount decimal(12,2), "
    "discount_amount decimal(12,2), net_amount decimal(12,2), cost_amount decimal(12,2), hour_of_day int, day_of_week int",
    "fact_orders_daily": "time_key int, branch_key long, total_orders long, total_gross decimal(18,2), "
    "total_discount decimal(18,2), total_net decimal(18,2), total_cost decimal(18,2)",
    "fact_inventory": "time_key int, branch_key long, product_key long, total_restocked long, total_consumed long, "
    "closing_stock long",
}


@dataclass(frozen=True)
class Warehouse:
    folder: str

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def dimension(self, spark: SparkSession, name: str, load: int) -> DataFrame:
        return spark.read.schema(DIMENSIONS[name]).parquet(f"{self.path(name)}/load={load}")

    def fact(self, spark: SparkSession, name: str, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
        """A stored fact; the day range becomes a partition filter."""
        df = spark.read.schema(FACTS[name]).parquet(self.path(name))
        if first is not None:
            df = df.filter(F.col("time_key") >= day_key(first))
        return df if last is None else df.filter(F.col("time_key") <= day_key(last))

    def load_dimensions(self, t, load: int, today: dt.date) -> None:
        """Write load number ``load`` from the one before; load 1 starts from nothing."""
        specs = {
            "dim_branch": (t.branches, "branch_id", "branch_key", ["name"], DIM_BRANCH),
            "dim_product": (t.products, "product_id", "product_key", ["name", "category"], DIM_PRODUCT),
        }
        for name, (source, natural, surrogate, attributes, schema) in specs.items():
            before = t.spark.createDataFrame([], schema) if load == 1 else self.dimension(t.spark, name, load - 1)
            members = source.select(F.col("id").alias(natural), *attributes)
            dim = star.upsert_dim(before, members, natural, surrogate, attributes).withColumns(
                {"valid_from": F.coalesce("valid_from", F.lit(today)), "is_current": F.coalesce("is_current", F.lit(True))}
            )
            overwrite_table(dim, f"{self.path(name)}/load={load}")
        overwrite_table(star.dim_time(t.order_times), f"{self.path('dim_time')}/load={load}")

    def infer_members(self, spark: SparkSession, load: int, sold: DataFrame) -> int:
        """Give every branch_id and product_id of ``sold`` (events or items, say) a row in
        the dimensions: load number ``load``, if they all have one there, or the next,
        with placeholders. A later ``load_dimensions`` fills these in."""
        sides = {"dim_branch": ("branch_id", "branch_key"), "dim_product": ("product_id", "product_key")}
        dims = {name: self.dimension(spark, name, load) for name in sides}
        unknown = [sold.join(dims[n], sold[k].cast("long") == dims[n][k], "left_anti").filter(sold[k].isNotNull()) for n, (k, _) in sides.items()]
        if all(df.isEmpty() for df in unknown):
            return load
        for name, (natural, surrogate) in sides.items():
            dim = star.infer_members(dims[name], sold, natural, surrogate)
            overwrite_table(dim, f"{self.path(name)}/load={load + 1}")
        overwrite_table(self.dimension(spark, "dim_time", load), f"{self.path('dim_time')}/load={load + 1}")
        return load + 1

    def load_facts(self, t, load: int, days: tuple[dt.date, dt.date] | None = None) -> None:
        """Reload the facts, all of them or only those of a range of days; a day of the
        range that has no rows any more is emptied.

        For a range, ``t`` should read only that range. The daily totals are
        taken from the sales as just written, not worked out again.
        """
        spark = t.spark
        branches, products = self.dimension(spark, "dim_branch", load), self.dimension(spark, "dim_product", load)
        first, last = days or (None, None)

        def write(df: DataFrame, name: str) -> None:
            if days is None:
                overwrite_table(df, self.path(name), ["time_key"])
            else:
                reload_range(df, self.path(name), "time_key", day_key(first), day_key(last))

        sales = star.fact_sales(t.costed_items, t.orders, None, branches, products)
        write(sales, "fact_sales")
        daily = deltas.state_of(self.fact(spark, "fact_sales", first, last))
        write(daily, "fact_orders_daily")
        stock = star.fact_inventory(t.inventory_logs, branches, products)
        write(stock, "fact_inventory")

    def apply_order_changes(
        self, t, load: int, changed: DataFrame, days: tuple[dt.date, dt.date] | None = None
    ) -> None:
        """Bring ``fact_sales`` and ``fact_orders_daily`` up to date after some orders, by
        ``order_id`` in ``changed``, were inserted, changed or deleted.

        ``t`` has the orders as they are now. ``days`` bounds the days on which the changed
        orders were before; without it their old lines are looked for on all days. Only
        days that an old or a new line is on are written again, and the daily totals of
        these take back the old lines and add the new ones.
        """
        spark, first_last = changed.sparkSession, days or (None, None)
        ids = changed.select(F.col("order_id").cast("long").alias("order_id")).distinct()
        branches, products = self.dimension(spark, "dim_branch", load), self.dimension(spark, "dim_product", load)
        work = f"{self.folder}/_changes-{uuid.uuid4().hex}"

        def kept(df: DataFrame, name: str) -> DataFrame:
            df.write.parquet(f"{work}/{name}")
            return spark.read.schema(df.schema).parquet(f"{work}/{name}")

        ids = kept(ids, "ids")
        stored = self.fact(spark, "fact_sales", *first_last)
        old = kept(stored.join(ids, "order_id", "left_semi"), "old")
        items = t.costed_items.join(ids, "order_id", "left_semi")
        orders = t.orders.join(ids.withColumnRenamed("order_id", "id"), "id", "left_semi")
        new = kept(star.fact_sales(items, orders, None, branches, products).select(*old.columns), "new")
        touched = sorted(r[0] for r in old.select("time_key").union(new.select("time_key")).distinct().collect())
        on_days = F.col("time_key").isin(touched)
        others = self.fact(spark, "fact_sales").filter(on_days).join(ids, "order_id", "left_anti")
        sales = kept(others.select(*old.columns).unionByName(new), "sales")
        before = spark.read.parquet(self.path("fact_orders_daily")).filter(on_days)
        daily = kept(deltas.added_up(before.unionByName(deltas.change_of(old, new))), "daily")
        reload_values(sales, self.path("fact_sales"), "time_key", touched)
        reload_values(daily, self.path("fact_orders_daily"), "time_key", touched)
        delete(spark, work)
