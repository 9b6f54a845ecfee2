"""Demand features per branch and product."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ml_features(daily: DataFrame, by_days: bool = False) -> DataFrame:
    """Rolling revenue, popularity trend and branch demand index per day.

    The rolling frame counts the last seven rows of a (branch, product), so
    days without sales stretch it; ``by_days`` counts calendar days instead.
    The divisor of the trend is always seven. A branch's mean is a small
    aggregate joined back: no task has to hold all rows of a branch.
    """
    series = Window.partitionBy("branch_id", "product_id")
    if by_days:
        frame = series.orderBy(F.unix_date("date")).rangeBetween(-6, 0)
    else:
        frame = series.orderBy("date").rowsBetween(-6, 0)
    means = daily.groupBy("branch_id").agg(F.avg("transaction_count").alias("_mean"))
    rolled = daily.withColumn("_revenue", F.sum("daily_revenue").over(frame)).withColumn(
        "_units", F.sum("daily_quantity").over(frame)
    )
    return rolled.join(means.withColumnRenamed("branch_id", "_branch"), F.col("branch_id").eqNullSafe(F.col("_branch"))).select(
        F.col("date").alias("feature_date"),
        "branch_id",
        "product_id",
        F.round("_revenue", 2).alias("rolling_7d_sales"),
        F.round(F.col("_units") / F.lit(7.0), 4).alias("popularity_trend_score"),
        F.round(F.col("transaction_count") / F.col("_mean"), 4).alias("branch_demand_index"),
    )
