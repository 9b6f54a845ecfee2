"""Ordered folds over per-key event histories, split so that a hot key is spread.

The history of a key is cut into pieces of about equal length (see ``pieces``). Each piece
is folded on its own, the one-row results are chained per key, and the carry is joined
back. One task handles one piece, not one key, however close together its events lie.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .pieces import PIECE_ROWS, with_pieces


def clamped_balance(
    events: DataFrame,
    keys: Sequence[str],
    change: str,
    order: Sequence[str],
    opening: DataFrame | None = None,
    opening_column: str = "quantity",
    rows: int = PIECE_ROWS,
    before: str | None = None,
) -> DataFrame:
    """Balance after each event, where every step is max(0, balance + change).

    With S the running sum from the opening level, the balance equals
    S - min(0, lowest S so far). ``order`` must be unique per key. Events with a
    NULL key are a key of their own. A key is cut into pieces of about ``rows``.
    Adds ``quantity`` and, if named, ``before``: the balance after the key's event
    before, from the same sums; NULL on the first.
    """
    keys = list(keys)
    cut = with_pieces(events, keys, order, "_piece", rows)
    within = Window.partitionBy(*keys, "_piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = cut.withColumn("_sum", F.sum(change).over(within))
    low_before = F.min("_sum").over(within.rowsBetween(Window.unboundedPreceding, -1))
    local = local.withColumns({"_low": F.min("_sum").over(within), "_low_before": low_before})

    totals = local.groupBy(*keys, "_piece").agg(F.sum(change).alias("_net"), F.min("_low").alias("_dip"))
    if opening is None:
        totals = totals.withColumn("_open", F.lit(0).cast("long"))
    else:
        start = opening.select(*keys, F.col(opening_column).cast("long").alias("_open"))
        totals = totals.join(start, keys, "left").fillna(0, ["_open"])
    earlier = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.withColumn("_base", F.col("_open") + F.coalesce(F.sum("_net").over(earlier), F.lit(0)))
    carried = carried.withColumn("_lowest", F.min(F.col("_base") + F.col("_dip")).over(earlier))
    carried = carried.withColumn("_opens", F.count(F.lit(1)).over(earlier) == 0)
    carried = carried.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col("_piece").alias("_k_piece"), "_base", "_opens", F.coalesce("_lowest", F.lit(0)).alias("_lowest"),
    )

    running = F.col("_base") + F.col("_sum")
    lowest = F.least(F.lit(0), F.col("_lowest"), F.col("_base") + F.col("_low"))
    same = F.col("_piece") == F.col("_k_piece")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    result = [*events.columns, (running - lowest).cast("long").alias("quantity")]
    if before is not None:
        # NULL among the lowest: nothing precedes the event in its piece.
        lowest_before = F.least(F.lit(0), F.col("_lowest"), F.col("_base") + F.col("_low_before"))
        level = (running - F.col(change) - lowest_before).cast("long")
        opens_key = F.col("_opens") & F.col("_low_before").isNull()
        result.append(F.when(~opens_key, level).alias(before))
    return local.join(carried, same).select(*result)


def with_previous(
    events: DataFrame, keys: Sequence[str], value: str, order: Sequence[str], name: str, rows: int = PIECE_ROWS
) -> DataFrame:
    """LAG(value) over each key's history, NULL on the first event of a key.

    Only the first event of a piece looks beyond it, at the last value of the
    piece before; those events, one per piece, carry their piece's last value.
    """
    keys = list(keys)
    cut = with_pieces(events, keys, order, "_piece", rows)
    within = Window.partitionBy(*keys, "_piece").orderBy(*order)
    whole = within.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    local = (
        cut.withColumn("_lag", F.lag(value).over(within))
        .withColumn("_row", F.row_number().over(within))
        .withColumn("_last", F.last(value).over(whole))
    )
    by_piece = Window.partitionBy(*keys).orderBy("_piece")
    firsts = local.filter(F.col("_row") == 1).withColumn("_lag", F.lag("_last").over(by_piece))
    others = local.filter(F.col("_row") > 1)
    return firsts.unionByName(others).select(*events.columns, F.col("_lag").alias(name))


def level_changes(
    levels: DataFrame, keys: Sequence[str], level: str, order: Sequence[str], rows: int = PIECE_ROWS, before: str | None = None
) -> DataFrame:
    """Change log of a level history: rows where the level moved, the amount and
    why. The first level of a key has nothing to compare with and is no change.
    ``before`` names the level before, if the rows have it."""
    if before is None:
        before = "_before"
        levels = with_previous(levels, keys, level, order, before, rows)
    delta = F.col(level) - F.col(before)
    reason: Column = F.when(delta > 0, F.lit("RESTOCK")).otherwise(F.lit("CONSUMPTION"))
    return levels.filter(delta != 0).select(
        *keys,
        *order,
        delta.cast("long").alias("change_amount"),
        F.col(level).cast("long").alias("new_stock_level"),
        reason.alias("reason"),
    )
