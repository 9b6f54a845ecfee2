"""Order totals, stock and the signed stock ledger."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import all_of, from_cents, optional_equal, pg_asc, pg_desc, to_cents, within_days
from ..operators import clamped_balance, combinations, insert_absent, newest_first, page, page_after, page_info, update_from, update_where

STOCK_KEY = ["branch_id", "product_id"]
SHELF_KEY = ["store_id", "product_id"]
COST_RATE = "0.4"


def order_totals(items: DataFrame) -> DataFrame:
    """Header totals of each order."""
    return items.groupBy("order_id").agg(
        from_cents(F.sum(to_cents(F.col("unit_price")) * F.col("quantity"))).alias("gross_amount"),
        from_cents(F.sum(to_cents(F.col("discount")))).alias("discount_amount"),
    )


def cost_price_default(products: DataFrame) -> DataFrame:
    """Products whose cost is unknown or zero cost 40 % of their price."""
    cost = F.col("cost_price")
    default = (F.col("base_price") * F.lit(COST_RATE).cast("decimal(2,1)")).cast("decimal(10,2)")
    return update_where(products, (cost == 0) | cost.isNull(), {"cost_price": default})


def stock_matrix_init(branches: DataFrame, products: DataFrame, existing: DataFrame, level: int = 10_000) -> DataFrame:
    """Opening stock for each (branch, product) that has none yet."""
    pairs = combinations(
        branches.select(F.col("id").alias("branch_id")),
        products.select(F.col("id").alias("product_id")),
    )
    fresh = pairs.withColumn("stock_level", F.lit(level).cast("long"))
    return fresh.join(existing.select(*STOCK_KEY), STOCK_KEY, "left_anti")


def stock_of_assortment(assortment: DataFrame, existing: DataFrame, level: int = 10_000) -> DataFrame:
    """Opening stock for each (branch, product) of an assortment that has none yet: as long
    as the assortment, where ``stock_matrix_init`` is as long as all combinations."""
    pairs = assortment.select(*STOCK_KEY).distinct().withColumn("stock_level", F.lit(level).cast("long"))
    return pairs.join(existing.select(*STOCK_KEY), STOCK_KEY, "left_anti")


def deplete(stock: DataFrame, taken: DataFrame) -> DataFrame:
    """Stock after consumption (``total_qty`` per key). It may go below zero."""
    left = (F.col("stock_level") - F.col("total_qty")).cast("long")
    return update_from(stock, taken, STOCK_KEY, {"stock_level": left})


def ledger_balance(ledger: DataFrame, opening: DataFrame | None = None) -> DataFrame:
    """Stock after every ledger row, never below zero."""
    folded = clamped_balance(ledger, SHELF_KEY, "change_amount", ["created_at", "id"], opening)
    return folded.select(*SHELF_KEY, "id", "created_at", "quantity")


def ledger_sync(inventory: DataFrame, ledger: DataFrame) -> DataFrame:
    """Add each key's net change at once and clamp the result, which differs from
    clamping at every step. Keys without ledger rows stay as they are."""
    net = ledger.groupBy(*SHELF_KEY).agg(F.sum("change_amount").alias("net_change"))
    level = F.greatest(F.lit(0).cast("long"), F.col("quantity") + F.col("net_change"))
    return update_from(inventory, net, SHELF_KEY, {"quantity": level})


def sync_as_ledger_rows(inventory: DataFrame, ledger: DataFrame) -> DataFrame:
    """The ledger rows behind setting stock to its level after ``ledger_sync``: more is
    an import, less a sale. Old and new level come from one join."""
    net = ledger.groupBy(*SHELF_KEY).agg(F.sum("change_amount").alias("net_change"))
    level = F.greatest(F.lit(0).cast("long"), F.col("quantity") + F.col("net_change"))
    changed = inventory.join(net, SHELF_KEY).withColumn("change_amount", (level - F.col("quantity")).cast("long"))
    return changed.filter(F.col("change_amount") != 0).select(
        *SHELF_KEY, "change_amount", F.when(F.col("change_amount") > 0, "import").otherwise("sale").alias("type")
    )


# ---- queries over the ledger ------------------------------------------------


def transaction_summary(ledger: DataFrame, as_of: dt.datetime, days: int = 30) -> DataFrame:
    return (
        ledger.filter(within_days("created_at", as_of, days))
        .groupBy("type")
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.sum("change_amount").alias("net_change"),
            F.avg(F.abs("change_amount")).alias("avg_amount"),
        )
        .orderBy(pg_desc("count"), pg_asc("type"))
    )


def _daily(ledger: DataFrame, kind: str, sign: int, name: str, as_of: dt.datetime, days: int) -> DataFrame:
    return (
        ledger.filter((F.col("type") == kind) & within_days("created_at", as_of, days))
        .groupBy(F.to_date("created_at").alias("date"))
        .agg(F.sum(F.col("change_amount") * sign).alias(name))
        .orderBy(pg_asc("date"))
    )


def sales_over_time(ledger: DataFrame, as_of: dt.datetime, days: int = 30) -> DataFrame:
    return _daily(ledger, "sale", -1, "total_sales", as_of, days)


def imports_over_time(ledger: DataFrame, as_of: dt.datetime, days: int = 30) -> DataFrame:
    return _daily(ledger, "import", 1, "total_imports", as_of, days)


def sales_trend(ledger: DataFrame, as_of: dt.datetime, days: int = 30) -> DataFrame:
    """Sales and imports per day in one pass, matched by date; 0 where one is missing."""
    kind, change = F.col("type"), F.col("change_amount")
    return (
        ledger.filter(kind.isin("sale", "import") & within_days("created_at", as_of, days))
        .groupBy(F.to_date("created_at").alias("date"))
        .agg(
            F.sum(F.when(kind == "sale", -change).otherwise(0)).alias("sales"),
            F.sum(F.when(kind == "import", change).otherwise(0)).alias("imports"),
        )
        .withColumn("label", F.date_format("date", "MMM d"))
        .orderBy(pg_asc("date"))
    )


def transaction_stats(ledger: DataFrame, store_id: int | None = None, product_id: int | None = None) -> DataFrame:
    wanted = all_of([optional_equal("store_id", store_id), optional_equal("product_id", product_id)])
    return (
        ledger.filter(wanted)
        .groupBy("type")
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.sum("change_amount").alias("total_change"),
            F.avg("change_amount").alias("avg_change"),
            F.min("created_at").alias("first_transaction"),
            F.max("created_at").alias("last_transaction"),
        )
    )


def _labelled(
    ledger: DataFrame, stores: DataFrame, products: DataFrame,
    store_id: int | None, product_id: int | None, kind: str | None,
) -> DataFrame:
    wanted = all_of(
        [
            optional_equal("store_id", store_id, zero_means_all=True),
            optional_equal("product_id", product_id, zero_means_all=True),
            optional_equal("type", kind, zero_means_all=True),
        ]
    )
    store = stores.select(F.col("id").alias("store_id"), F.col("name").alias("store"))
    product = products.select(F.col("id").alias("product_id"), F.col("name").alias("product"), "category", "unit")
    return ledger.filter(wanted).join(product, "product_id").join(store, "store_id")


def transactions_page(
    ledger: DataFrame, stores: DataFrame, products: DataFrame, users: DataFrame, *,
    store_id: int | None = None, product_id: int | None = None, kind: str | None = None,
    limit: int = 100, offset: int = 0,
) -> DataFrame:
    """Newest ledger rows with their labels.

    Who wrote a row is looked up for the page only: that join neither drops nor
    repeats rows, so it can follow the limit.
    """
    rows = _labelled(ledger, stores, products, store_id, product_id, kind)
    return _with_author(page(rows, [pg_desc("created_at"), pg_desc("id")], limit, offset), users)


def transactions_page_after(
    ledger: DataFrame, stores: DataFrame, products: DataFrame, users: DataFrame, *,
    kind: str | None = None, limit: int = 100, last: tuple[dt.datetime, int] | None = None,
) -> DataFrame:
    """The page that follows the row (created_at, id): a deep page costs as much as the first."""
    rows = _labelled(ledger, stores, products, None, None, kind)
    return _with_author(page_after(rows, "created_at", "id", limit, last), users)


def _with_author(top: DataFrame, users: DataFrame) -> DataFrame:
    """Names for the rows of a page, and its order again: the join does not keep it."""
    author = users.select(F.col("id").alias("_author"), F.col("name").alias("created_by_name"))
    labelled = top.join(author, F.col("created_by") == F.col("_author"), "left").select(
        "id", "store_id", "product_id", "change_amount", "type", "created_by", "created_at",
        "store", F.col("store").alias("store_name"), "product", F.col("product").alias("product_name"),
        "category", "unit", "created_by_name",
    )
    return newest_first(labelled, "created_at", "id")


def transaction_by_id(ledger: DataFrame, stores: DataFrame, products: DataFrame, users: DataFrame, id: int) -> DataFrame:
    """One ledger row with its labels; no row when the id is unknown."""
    return transactions_page(ledger.filter(F.col("id") == id), stores, products, users, limit=1)


def transactions_page_info(
    ledger: DataFrame, stores: DataFrame, products: DataFrame, *,
    store_id: int | None = None, kind: str | None = None, number: int = 1, size: int = 20,
) -> DataFrame:
    return page_info(_labelled(ledger, stores, products, store_id, None, kind), number, size)


def seed_products(existing: DataFrame, payloads: DataFrame) -> DataFrame:
    """Catalogue rows to insert from exploded uploads; the first of a name wins."""
    return insert_absent(existing, payloads, ["name"], order=["upload_id", "position"])
