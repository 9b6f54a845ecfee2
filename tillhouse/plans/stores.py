"""Stock of the stores: lists, totals and key figures."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import all_of, contains_any, optional_equal, pg_asc, pg_desc, ratio, within_days


def _store_names(stores: DataFrame, *more: str) -> DataFrame:
    return stores.select(F.col("id").alias("store_id"), F.col("name").alias("store"), *more)


def _product_names(products: DataFrame, *more: str) -> DataFrame:
    return products.select(F.col("id").alias("product_id"), F.col("name").alias("product"), "category", *more)


def _is_low():
    return F.col("quantity") <= F.col("low_stock")


def _scoped(inventory: DataFrame, store_id: int | None) -> DataFrame:
    return inventory.filter(all_of([optional_equal("store_id", store_id, zero_means_all=True)]))


def inventory_list(inventory: DataFrame, stores: DataFrame, products: DataFrame, store_id: int | None = None) -> DataFrame:
    """All stock with labels, by store, category and product."""
    listed = (
        _scoped(inventory, store_id)
        .join(_product_names(products, "unit"), "product_id")
        .join(_store_names(stores, "location"), "store_id")
    )
    columns = ["id", "quantity", "low_stock", "product_id", "product", "category", "unit", "store_id", "store", "location"]
    order = [pg_asc(c) for c in [*([] if store_id else ["store"]), "category", "product", "id"]]
    return listed.select(*columns).orderBy(*order)


def stock_chart(inventory: DataFrame, stores: DataFrame, products: DataFrame, bars: int = 8) -> DataFrame:
    """The first rows of the stock list with short labels."""
    top = inventory_list(inventory, stores, products).limit(bars)
    return top.select(F.substring("product", 1, 15).alias("name"), "quantity", "low_stock")


def search(listed: DataFrame, columns: list[str], term: str) -> DataFrame:
    """Rows in which any of the columns contains the term, in any case."""
    return listed.filter(contains_any(term, *columns)) if term else listed


def low_stock_items(
    inventory: DataFrame, stores: DataFrame, products: DataFrame,
    store_id: int | None = None, limit: int | None = None,
) -> DataFrame:
    """Stock at or below its threshold, lowest first; ``limit`` for a preview."""
    low = (
        _scoped(inventory, store_id)
        .filter(_is_low())
        .join(_product_names(products, "unit", "price"), "product_id")
        .join(_store_names(stores), "store_id")
        .select("id", "quantity", "low_stock", "store_id", "store", "product_id", "product", "category", "unit", "price")
        .orderBy(pg_asc("quantity"), pg_asc("id"))
    )
    return low if limit is None else low.limit(limit)


def low_stock_by_ratio(inventory: DataFrame, stores: DataFrame, products: DataFrame, store_id: int | None = None) -> DataFrame:
    """The same rows by fill ratio; without a threshold there is no ratio, and the row comes last."""
    fill = ratio(F.col("quantity"), F.col("low_stock"))
    return (
        _scoped(inventory, store_id)
        .filter(_is_low())
        .join(_product_names(products, "unit"), "product_id")
        .join(_store_names(stores), "store_id")
        .orderBy(pg_asc(fill), pg_asc("id"))
        .select("id", "quantity", "low_stock", "product", "category", "unit", "store", "store_id")
    )


def _per_store(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy("store_id").agg(
        F.count("id").alias("product_count"),
        F.sum("quantity").alias("total_quantity"),
        F.avg("quantity").alias("avg_quantity"),
        F.sum(F.when(_is_low(), 1).otherwise(0)).alias("low_stock_count"),
    )


def inventory_by_store(inventory: DataFrame, stores: DataFrame) -> DataFrame:
    """Totals of the stores that have stock. Stock is summed before the join."""
    return (
        _per_store(inventory)
        .join(_store_names(stores, "location"), "store_id")
        .select("store_id", "store", "location", "product_count", "total_quantity", "low_stock_count")
        .orderBy(pg_asc("store_id"))
    )


def store_comparison(inventory: DataFrame, stores: DataFrame) -> DataFrame:
    """Totals of all stores; one without stock counts as 0."""
    return (
        _store_names(stores)
        .join(_per_store(inventory), "store_id", "left")
        .select(
            "store_id",
            "store",
            F.coalesce("total_quantity", F.lit(0)).alias("total_quantity"),
            F.coalesce("avg_quantity", F.lit(0.0)).alias("avg_quantity"),
            F.coalesce("product_count", F.lit(0)).alias("product_count"),
        )
        .orderBy(pg_desc("total_quantity"), pg_asc("store_id"))
    )


def category_breakdown(inventory: DataFrame, products: DataFrame) -> DataFrame:
    """Stock per category; ``product_count`` counts stock rows, not products.
    Stock is summed per product before the join."""
    per_product = inventory.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("_rows"), F.sum("quantity").alias("_sum"), F.count("quantity").alias("_known")
    )
    return (
        per_product.join(_product_names(products), "product_id")
        .groupBy("category")
        .agg(
            F.sum("_rows").alias("product_count"),
            F.sum("_sum").alias("total_stock"),
            ratio(F.sum("_sum"), F.sum("_known")).alias("avg_stock"),
        )
        .orderBy(pg_desc("total_stock"), pg_asc("category"))
    )


def inventory_value(inventory: DataFrame, stores: DataFrame, products: DataFrame) -> DataFrame:
    prices = products.select(F.col("id").alias("product_id"), "price")
    value = F.col("quantity") * F.col("price")
    totals = inventory.join(prices, "product_id").groupBy("store_id").agg(F.sum(value).alias("total_value"))
    return (
        totals.join(_store_names(stores), "store_id")
        .select("store_id", "store", "total_value")
        .orderBy(pg_desc("total_value"), pg_asc("store_id"))
    )


def top_selling(ledger: DataFrame, products: DataFrame, limit: int = 10, store_id: int | None = None) -> DataFrame:
    """Products with the most units sold. Sums per (product, store) come first,
    so counting a product's stores needs no list of them."""
    sold = (
        ledger.filter(all_of([F.col("type") == "sale", optional_equal("store_id", store_id, zero_means_all=True)]))
        .groupBy("product_id", "store_id")
        .agg(F.sum(-F.col("change_amount")).alias("_sold"))
        .groupBy("product_id")
        .agg(F.sum("_sold").alias("total_sold"), F.count("store_id").alias("stores_sold"))
    )
    return (
        sold.join(_product_names(products, "unit"), "product_id")
        .orderBy(pg_desc("total_sold"), pg_asc("product_id"))
        .limit(limit)
        .select(F.col("product_id").alias("id"), "product", "category", "unit", "total_sold", "stores_sold")
    )


def store_kpi(
    stores: DataFrame, products: DataFrame, users: DataFrame, inventory: DataFrame, ledger: DataFrame,
    as_of: dt.datetime, store_id: int | None = None,
) -> DataFrame:
    """Six figures in one row. ``total_stock`` is NULL without stock rows;
    ``daily_sales`` counts sale rows of the last 24 hours. One scan of the stock
    gives both stock figures; the others are scalar subqueries."""
    n = F.count(F.lit(1)).alias("n")
    scoped_stores = stores.filter(F.col("id") == store_id) if store_id else stores
    scoped_users = _scoped(users.filter(F.col("active")), store_id)
    sales = _scoped(ledger, store_id).filter((F.col("type") == "sale") & within_days("created_at", as_of, 1))
    stock = _scoped(inventory, store_id).agg(
        F.sum("quantity").alias("total_stock"), F.count_if(_is_low()).alias("low_stock_count")
    )
    return stock.select(
        scoped_stores.agg(n).scalar().alias("store_count"),
        products.agg(n).scalar().alias("product_count"),
        scoped_users.agg(n).scalar().alias("user_count"),
        "total_stock",
        "low_stock_count",
        sales.agg(n).scalar().alias("daily_sales"),
    )


# ---- lists and lookups ------------------------------------------------------


def store_list(stores: DataFrame) -> DataFrame:
    return stores.select("id", "name", "location").orderBy(pg_asc("name"), pg_asc("id"))


def product_list(products: DataFrame) -> DataFrame:
    return products.select("id", "name", "category", "unit").orderBy(pg_asc("category"), pg_asc("name"), pg_asc("id"))


def branch_list(branches: DataFrame) -> DataFrame:
    return branches.select("id", "name").orderBy(pg_asc("id"))
