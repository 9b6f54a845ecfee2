"""Stock set by users: store check, new stock and ledger rows of a batch of edits.

A batch gives what its edits give one after the other: an edit of another store than the
user's own is refused, unless the user is an administrator; each of the others sets the
stock of its store and product, and the ledger gets what it changed against the level
before it, be that of an earlier edit or of the stock.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import upsert, with_previous
from .access import ADMIN

KEY = ["store_id", "product_id"]
ORDER = ["created_at", "id"]
LOW_STOCK = 10


def checked(edits: DataFrame, users: DataFrame, roles: DataFrame) -> DataFrame:
    """Edits (id, user_id, store_id, product_id, quantity, low_stock, created_at) with their
    ``outcome``: ``invalid`` without a store, product or quantity, ``refused`` by the store
    check or for want of an active user, else ``accepted``. Id 0 counts as none."""
    scope = users.filter("active").select(F.col("id").alias("user_id"), "role_id", F.col("store_id").alias("_own"))
    scope = scope.join(roles.select(F.col("id").alias("role_id"), F.col("name").alias("_role")), "role_id").drop("role_id")
    given = (F.col("store_id") != 0) & (F.col("product_id") != 0) & F.col("quantity").isNotNull()
    own = (F.col("_role") == ADMIN) | (F.col("store_id") == F.col("_own"))
    outcome = F.when(~F.coalesce(given, F.lit(False)), "invalid").when(F.coalesce(own, F.lit(False)), "accepted").otherwise("refused")
    return edits.join(scope, "user_id", "left").withColumn("outcome", outcome).drop("_role", "_own")


def _accepted(edits: DataFrame) -> DataFrame:
    return edits.filter(F.col("outcome") == "accepted").drop("outcome")


def ledger_of_edits(stock: DataFrame, checked_edits: DataFrame) -> DataFrame:
    """The ledger rows of the accepted edits: more is an import, less a sale, equal nothing."""
    rows = with_previous(_accepted(checked_edits), KEY, "quantity", ORDER, "_before")
    old = stock.select(*KEY, F.col("quantity").alias("_stock"))
    change = (F.col("quantity") - F.coalesce("_before", "_stock", F.lit(0))).cast("long")
    rows = rows.join(old, KEY, "left").withColumn("change_amount", change).filter("change_amount <> 0")
    return rows.select(
        F.col("id").alias("edit_id"),
        *KEY,
        "change_amount",
        F.when(F.col("change_amount") > 0, "import").otherwise("sale").alias("type"),
        F.col("user_id").alias("created_by"),
        "created_at",
    )


def stock_after_edits(stock: DataFrame, checked_edits: DataFrame) -> DataFrame:
    """``stock`` (store_id, product_id, quantity, low_stock) after the accepted edits. The
    last edit of a key holds; without a threshold it sets LOW_STOCK."""
    level = F.struct(F.col("quantity").cast("long").alias("quantity"), F.coalesce("low_stock", F.lit(LOW_STOCK)).cast("long").alias("low_stock"))
    last = _accepted(checked_edits).groupBy(*KEY).agg(F.max_by(level, F.struct(*ORDER)).alias("_l")).select(*KEY, "_l.*")
    return upsert(stock.select(*KEY, "quantity", "low_stock"), last, KEY, ["quantity", "low_stock"])
