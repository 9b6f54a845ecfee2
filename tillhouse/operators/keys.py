"""Surrogate keys: existing ones are kept, new rows continue the sequence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Hex digits of a key's MD5 that name its numbering block: 65,536 blocks, over which
# keys of any type, dense or sparse, spread evenly. One task numbers one block.
BLOCK_DIGITS = 4


def _block(key: str) -> Column:
    missing = F.raise_error(F.lit(f"a row to be numbered has no {key}")).cast("string")
    return F.when(F.col(key).isNull(), missing).otherwise(F.substring(F.md5(F.col(key).cast("string")), 1, BLOCK_DIGITS))


def number_missing(df: DataFrame, key: str, surrogate: str) -> DataFrame:
    """Number the rows whose ``surrogate`` is NULL, after the highest there is.

    Keys must be unique; a row to be numbered that has none is an error. The
    sequence has no gaps and follows no order that means anything: blocks come one
    after the other, by the MD5 of the key, and rows inside by key. The table of
    blocks is one small window; no task sees the whole frame. ``df`` must not change
    when it is worked out twice.
    """
    new = F.col(surrogate).isNull()
    named = F.coalesce(F.substring(F.md5(F.col(key).cast("string")), 1, BLOCK_DIGITS), F.lit(""))
    blocked = df.withColumn("_block", F.when(new, _block(key)).otherwise(named))
    everything = Window.partitionBy(F.lit(1))
    before = everything.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    # Counting any non-null column keeps the columns read here and in the final
    # join alike, so that Spark works out a joined input only once.
    touched = F.coalesce(*[F.when(F.col(c).isNotNull(), 1) for c in df.columns], F.lit(1))
    starts = (
        blocked.groupBy("_block")
        .agg(F.sum(F.when(new, touched).otherwise(F.lit(0))).alias("_n"), F.max(surrogate).alias("_high"))
        .select(
            "_block",
            (
                F.coalesce(F.max("_high").over(everything), F.lit(0)) + F.coalesce(F.sum("_n").over(before), F.lit(0))
            ).alias("_start"),
        )
    )
    inside = F.row_number().over(Window.partitionBy("_block", new).orderBy(key))
    numbered = blocked.withColumn("_row", inside).join(starts, "_block")
    number = F.coalesce(F.col(surrogate), F.col("_start") + F.col("_row")).cast("long")
    return numbered.withColumn(surrogate, number).select(*df.columns)


def number_rows(df: DataFrame, key: str, name: str) -> DataFrame:
    """Add ``name`` = 1, 2, 3 … to all rows, as ``number_missing`` does."""
    return number_missing(df.withColumn(name, F.lit(None).cast("long")), key, name)


def assign_surrogate_keys(existing: DataFrame, new: DataFrame, natural_key: str, surrogate: str) -> DataFrame:
    """Number the ``new`` rows after the highest key in ``existing``."""
    highest = existing.agg(F.coalesce(F.max(surrogate), F.lit(0)).alias("k")).scalar()
    numbered = number_rows(new, natural_key, "_seq")
    return numbered.withColumn(surrogate, (highest + F.col("_seq")).cast("long")).drop("_seq")
