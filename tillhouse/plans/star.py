"""Star schema: dimensions, facts and the whole refresh."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import day_name, from_cents, iso_weekday, money_sum, month_name, share_cents, time_key, to_cents
from ..operators import number_missing, upsert


def dim_time(orders: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One row per day with orders. The calendar columns are worked out once per
    day, after the distinct. With ``existing``, only days it lacks."""
    days = orders.select(F.to_date("created_at").alias("full_date")).distinct()
    if existing is not None:
        days = days.join(existing.select("full_date"), "full_date", "left_anti")
    d = F.col("full_date")
    return days.select(
        time_key(d).alias("time_key"),
        "full_date",
        iso_weekday(d).alias("day_of_week"),
        day_name(d).alias("day_name"),
        F.month(d).alias("month"),
        month_name(d).alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        iso_weekday(d).isin(6, 7).alias("is_weekend"),
    )


def upsert_dim(
    dim: DataFrame, source: DataFrame, natural_key: str, surrogate: str, attributes: Sequence[str]
) -> DataFrame:
    """Type-1 dimension load: known members keep key and other columns and take
    the new attributes; new members get the next keys. One join of the two tables."""
    return number_missing(upsert(dim, source, [natural_key], attributes), natural_key, surrogate)


def infer_members(dim: DataFrame, keys: DataFrame, natural_key: str, surrogate: str) -> DataFrame:
    """``dim`` and a placeholder for each natural key of ``keys`` that it lacks: the next
    surrogate keys, other columns NULL. Facts need not wait for the member, and the next
    ``upsert_dim`` that knows it fills the placeholder in under the same key."""
    wanted = keys.select(F.col(natural_key).cast(dim.schema[natural_key].dataType)).filter(F.col(natural_key).isNotNull())
    unknown = wanted.distinct().join(dim.select(natural_key), natural_key, "left_anti")
    return number_missing(dim.unionByName(unknown, allowMissingColumns=True), natural_key, surrogate)


def fact_sales(
    items: DataFrame, orders: DataFrame, products: DataFrame | None, dim_branch: DataFrame, dim_product: DataFrame
) -> DataFrame:
    """One row per order item, the order's discount split by item value.

    Discount and net are each rounded once from the exact quotient; both are
    NULL when the order total is 0. ``products`` may be None if the items have
    their ``cost_price``. Joins on the product come first, one after the other:
    where products are too many to broadcast, items are shuffled by product once
    for all of them, and once by order. Where the order totals are sums of the
    same items, both uses read the same columns, so that Spark scans and shuffles
    them once.
    """
    product_keys = dim_product.select("product_id", "product_key")
    headers = orders.select(
        F.col("id").alias("order_id"),
        "branch_id",
        time_key(F.col("created_at")).alias("time_key"),
        F.hour("created_at").alias("hour_of_day"),
        iso_weekday(F.col("created_at")).alias("day_of_week"),
        to_cents(F.col("gross_amount")).alias("_gross"),
        to_cents(F.col("discount_amount")).alias("_discount"),
    ).join(dim_branch.select("branch_id", "branch_key"), "branch_id")

    if products is not None:
        items = items.join(products.select(F.col("id").alias("product_id"), "cost_price"), "product_id")
    quantity = F.col("quantity")
    if "discount" in items.columns:  # read as the totals read it
        quantity = F.coalesce(F.when(F.col("discount").isNotNull(), quantity), quantity)
    items = items.join(product_keys, "product_id").withColumn("quantity", quantity)
    joined = items.join(headers, "order_id").withColumn("_item", to_cents(F.col("unit_price")) * F.col("quantity"))
    discount = share_cents(F.col("_discount"), F.col("_item"), F.col("_gross"))
    net = share_cents(F.col("_gross") - F.col("_discount"), F.col("_item"), F.col("_gross"))
    return joined.select(
        "time_key",
        "branch_key",
        "product_key",
        "order_id",
        "quantity",
        from_cents(F.col("_item")).alias("gross_amount"),
        from_cents(discount).alias("discount_amount"),
        from_cents(net).alias("net_amount"),
        from_cents(to_cents(F.col("cost_price")) * F.col("quantity")).alias("cost_amount"),
        "hour_of_day",
        "day_of_week",
    )


def fact_orders_daily(sales: DataFrame) -> DataFrame:
    """Day and branch totals.

    Rows are first summed per order, then per day: the distinct order count
    becomes a plain count and a busy branch is spread over its orders.
    """
    money = ["gross_amount", "discount_amount", "net_amount", "cost_amount"]
    per_order = sales.groupBy("time_key", "branch_key", "order_id").agg(*[money_sum(F.col(c)).alias(c) for c in money])
    return per_order.groupBy("time_key", "branch_key").agg(
        F.count("order_id").alias("total_orders"),
        money_sum(F.col("gross_amount")).alias("total_gross"),
        money_sum(F.col("discount_amount")).alias("total_discount"),
        money_sum(F.col("net_amount")).alias("total_net"),
        money_sum(F.col("cost_amount")).alias("total_cost"),
    )


def fact_inventory(
    logs: DataFrame, dim_branch: DataFrame, dim_product: DataFrame, *, closing: str = "max"
) -> DataFrame:
    """Stock movement per day, branch and product.

    ``closing="max"`` takes the day's highest level, as the source warehouse
    does; ``"last"`` the level after the day's last movement. Logs are summed
    per source id before the dimension joins.
    """
    reason, change = F.col("reason"), F.col("change_amount")
    closing_stock = {
        "max": F.max("new_stock_level"),
        "last": F.max_by("new_stock_level", F.struct("created_at", "id")),
    }[closing]
    daily = logs.groupBy(F.to_date("created_at").alias("_day"), "branch_id", "product_id").agg(
        F.sum(F.when(reason == "RESTOCK", change).otherwise(0)).alias("total_restocked"),
        F.sum(F.when(reason == "CONSUMPTION", F.abs(change)).otherwise(0)).alias("total_consumed"),
        closing_stock.alias("closing_stock"),
    )
    return (
        daily.join(dim_branch.select("branch_id", "branch_key"), "branch_id")
        .join(dim_product.select("product_id", "product_key"), "product_id")
        .select(
            time_key(F.col("_day")).alias("time_key"),
            "branch_key",
            "product_key",
            "total_restocked",
            "total_consumed",
            "closing_stock",
        )
    )


def build_star(t, dims: Mapping[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """All dimensions and facts from the operational tables ``t``. ``dims`` holds
    the dimensions of the load before; without it the given ones are used."""
    dim_branch, dim_product = t.dim_branch, t.dim_product
    if dims is not None:
        branches = t.branches.select(F.col("id").alias("branch_id"), "name")
        products = t.products.select(F.col("id").alias("product_id"), "name", "category")
        dim_branch = upsert_dim(dims["dim_branch"], branches, "branch_id", "branch_key", ["name"])
        dim_product = upsert_dim(dims["dim_product"], products, "product_id", "product_key", ["name", "category"])
    sales = fact_sales(t.costed_items, t.orders, None, dim_branch, dim_product)
    return {
        "dim_time": dim_time(t.order_times),
        "dim_branch": dim_branch,
        "dim_product": dim_product,
        "fact_sales": sales,
        "fact_orders_daily": fact_orders_daily(sales),
        "fact_inventory": fact_inventory(t.inventory_logs, dim_branch, dim_product),
    }
