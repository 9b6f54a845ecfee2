"""Change capture by comparing two snapshots of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _image(columns: Sequence[str], side: str):
    fields = [F.col(f"{side}.{c}").alias(c) for c in columns]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def snapshot_diff(before: DataFrame, after: DataFrame, key: str, table_name: str, user_id: int | None = None) -> DataFrame:
    """One audit row per created, changed or deleted key, with JSON row images.

    Rows are compared column by column, NULL equal to NULL.
    """
    columns = before.columns
    b, a = before.alias("b"), after.select(*columns).alias("a")
    joined = b.join(a, F.col(f"b.{key}") == F.col(f"a.{key}"), "full_outer")
    same = F.lit(True)
    for c in columns:
        same = same & F.col(f"b.{c}").eqNullSafe(F.col(f"a.{c}"))
    created, deleted = F.col(f"b.{key}").isNull(), F.col(f"a.{key}").isNull()
    return joined.filter(~same).select(
        F.lit(user_id).cast("long").alias("user_id"),
        F.when(created, "CREATE").when(deleted, "DELETE").otherwise("UPDATE").alias("action"),
        F.lit(table_name).alias("table_name"),
        F.coalesce(f"a.{key}", f"b.{key}").alias("record_id"),
        F.when(~created, _image(columns, "b")).alias("old_value"),
        F.when(~deleted, _image(columns, "a")).alias("new_value"),
    )


def stock_changes(before: DataFrame, after: DataFrame, keys: Sequence[str], created_by: int | None = None) -> DataFrame:
    """Ledger rows implied by a batch of new stock levels.

    ``after`` holds the levels that were set; a key unknown to ``before``
    starts from zero. More stock is an import, less a sale, equal is nothing.
    """
    old = before.select(*keys, F.col("quantity").alias("_old"))
    delta = F.col("quantity") - F.coalesce("_old", F.lit(0))
    return (
        after.join(old, list(keys), "left")
        .withColumn("change_amount", delta.cast("long"))
        .filter(F.col("change_amount") != 0)
        .select(
            *keys,
            "change_amount",
            F.when(F.col("change_amount") > 0, "import").otherwise("sale").alias("type"),
            F.lit(created_by).cast("long").alias("created_by"),
        )
    )
