"""RANK() without sorting a whole group, or the whole frame, in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: A group with more distinct values than this is cut into PIECES.
PIECE_VALUES = 1 << 20
PIECES = 64


def _with_piece(counts: DataFrame, by: Sequence[str], values: int) -> DataFrame:
    """Add ``_piece``, which never falls as the value rises; equal values share it.

    Its boundaries are quantiles of the group's distinct values, from a sketch that every
    task makes and that are put together, so close values are cut like any others.
    """
    at = [F.lit(k / PIECES) for k in range(1, PIECES)]
    # Summing the counts keeps the columns read here and below alike, so that Spark
    # shuffles an aggregated input only once.
    sketch = counts.groupBy(*[F.col(c).alias(f"_s_{c}") for c in by]).agg(
        F.count_if(F.col("_n") > 0).alias("_distinct"),
        F.percentile_approx(F.col("_value").cast("double"), F.array(*at), F.lit(64 * PIECES)).alias("_bounds"),
    )
    on = F.lit(True)
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_s_{c}"))
    piece = F.size(F.filter("_bounds", lambda b: b < F.col("_value").cast("double")))
    cut = (F.col("_distinct") > values) & F.col("_value").isNotNull()
    return counts.join(sketch, on).select(*counts.columns, F.when(cut, piece).otherwise(-1).alias("_piece"))


def rank_descending(
    df: DataFrame, value: str, by: Sequence[str] = (), name: str = "rank", values: int = PIECE_VALUES
) -> DataFrame:
    """RANK() OVER (PARTITION BY by ORDER BY value DESC), NULL values first.

    A row's rank depends only on how many rows of its group have a greater
    value. So the group is reduced to a count per value, and the counts are
    summed within and across pieces of the group's values. A group that holds a
    third of the rows is spread over its pieces, if it has more than ``values``
    different ones; ties collapse before the shuffle.
    """
    by = list(by)
    # Counting any non-null column keeps the columns read here and in the final
    # join alike, so that Spark shuffles an aggregated input only once.
    touched = F.coalesce(*[F.when(F.col(c).isNotNull(), 1) for c in df.columns], F.lit(1))
    counts = df.groupBy(*by, F.col(value).alias("_value")).agg(F.sum(touched).alias("_n"))
    counts = _with_piece(counts, by, values).withColumn("_bucket", F.when(F.col("_value").isNotNull(), F.col("_piece")))
    counts = counts.drop("_piece")

    above = Window.partitionBy(*by).orderBy(F.col("_bucket").desc_nulls_first())
    above = above.rowsBetween(Window.unboundedPreceding, -1)
    buckets = counts.groupBy(*by, "_bucket").agg(F.sum("_n").alias("_n"))
    buckets = buckets.select(
        *[F.col(c).alias(f"_b_{c}") for c in by],
        F.col("_bucket").alias("_b_bucket"),
        F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_above"),
    )

    inside = Window.partitionBy(*by, "_bucket").orderBy(F.col("_value").desc_nulls_first())
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    ranks = counts.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    on_bucket = F.col("_bucket").eqNullSafe(F.col("_b_bucket"))
    for c in by:
        on_bucket = on_bucket & F.col(c).eqNullSafe(F.col(f"_b_{c}"))
    ranks = ranks.join(buckets, on_bucket).select(
        *[F.col(c).alias(f"_r_{c}") for c in by],
        "_value",
        (F.col("_above") + F.col("_inside") + 1).alias(name),
    )

    on_value = F.col(value).eqNullSafe(F.col("_value"))
    for c in by:
        on_value = on_value & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    return df.join(ranks, on_value).drop("_value", *[f"_r_{c}" for c in by])
