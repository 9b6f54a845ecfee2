"""Views over the star schema.

Facts are summed by key before labels are joined, so a label join sees one row
per member. Names are unique per key, as the source tables enforce.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import money_sum, pg_asc, pg_desc, ratio
from ..operators import rank_descending


def _branch_names(dim_branch: DataFrame) -> DataFrame:
    return dim_branch.select("branch_key", F.col("name").alias("branch_name"))


def _product_names(dim_product: DataFrame) -> DataFrame:
    return dim_product.select("product_key", F.col("name").alias("product_name"))


def revenue_by_hour(sales: DataFrame) -> DataFrame:
    """Revenue and orders per hour of day. Orders are counted by a sum per order
    first: an hour with a third of all sales is spread over its orders."""
    per_order = sales.groupBy("hour_of_day", "order_id").agg(money_sum(F.col("net_amount")).alias("net"))
    return (
        per_order.groupBy("hour_of_day")
        .agg(money_sum(F.col("net")).alias("total_revenue"), F.count("order_id").alias("total_orders"))
        .orderBy(pg_asc("hour_of_day"))
    )


def top_products_branch(sales: DataFrame, dim_branch: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Every product a branch sold, ranked by units within the branch."""
    sold = sales.groupBy("branch_key", "product_key").agg(
        F.sum("quantity").alias("total_units_sold"), money_sum(F.col("net_amount")).alias("total_revenue")
    )
    # Said here rather than left to the label joins, so that both uses of the
    # sums in the ranking have one plan and share one shuffle.
    sold = sold.filter(F.col("branch_key").isNotNull() & F.col("product_key").isNotNull())
    ranked = rank_descending(sold, "total_units_sold", by=["branch_key"])
    return (
        ranked.join(_product_names(dim_product), "product_key")
        .join(_branch_names(dim_branch), "branch_key")
        .select("branch_name", "product_name", "total_units_sold", "total_revenue", "rank")
    )


def inventory_turnover(
    sales: DataFrame, inventory: DataFrame, dim_branch: DataFrame, dim_product: DataFrame, *, fan_out: bool = True
) -> DataFrame:
    """Cost of goods sold over average stock, per branch and product.

    The source view joins each sale to every inventory day of its product, so
    costs count once per day. ``fan_out`` gives that figure, as cost times
    number of days, without making the pairs; ``False`` counts costs once. The
    average stock is the same both ways.
    """
    key = ["branch_key", "product_key"]
    sold = sales.groupBy(*key).agg(money_sum(F.col("cost_amount")).alias("_cost"))
    stock = inventory.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_days"), F.avg("closing_stock").alias("_average")
    )
    joined = sold.join(stock, key, "left")
    cost = F.col("_cost") * F.coalesce("_days", F.lit(1)) if fan_out else F.col("_cost")
    return (
        joined.withColumn("_cogs", cost.cast("decimal(24,2)"))
        .join(_product_names(dim_product), "product_key")
        .join(_branch_names(dim_branch), "branch_key")
        .select(
            "branch_name",
            "product_name",
            F.col("_cogs").alias("Cost of Goods Sold"),
            F.coalesce("_average", F.lit(1.0)).alias("avg_inventory"),
            ratio(F.col("_cogs"), F.col("_average")).alias("turnover_rate"),
        )
    )


def profit_margin(orders_daily: DataFrame, dim_branch: DataFrame) -> DataFrame:
    net, cost = F.col("total_net"), F.col("total_cost")
    percent = F.when(net > 0, ratio(net - cost, net) * 100).otherwise(F.lit(0.0))
    return orders_daily.join(_branch_names(dim_branch), "branch_key").select(
        "time_key",
        "branch_name",
        net.alias("revenue"),
        cost.alias("cost"),
        (net - cost).alias("profit"),
        percent.alias("profit_margin_percent"),
    )


def branch_performance(orders_daily: DataFrame, dim_branch: DataFrame) -> DataFrame:
    totals = orders_daily.groupBy("branch_key").agg(
        money_sum(F.col("total_net")).alias("total_revenue"),
        F.sum("total_orders").alias("total_orders"),
        money_sum(F.col("total_net") - F.col("total_cost")).alias("total_profit"),
    )
    # A row per branch: a plain window over the whole frame is small.
    best_first = Window.partitionBy(F.lit(1)).orderBy(F.col("total_revenue").desc_nulls_first())
    ranked = totals.filter(F.col("branch_key").isNotNull()).withColumn("revenue_rank", F.rank().over(best_first).cast("long"))
    return (
        ranked.join(_branch_names(dim_branch), "branch_key")
        .select("branch_name", "total_revenue", "total_orders", "total_profit", "revenue_rank")
        .orderBy(pg_asc("revenue_rank"), pg_asc("branch_name"))
    )


def _branch_revenue(orders_daily: DataFrame, dim_branch: DataFrame) -> DataFrame:
    totals = orders_daily.groupBy("branch_key").agg(money_sum(F.col("total_net")).alias("revenue"))
    return totals.join(_branch_names(dim_branch), "branch_key").select(F.col("branch_name").alias("branch"), "revenue")


def branch_best_worst(orders_daily: DataFrame, dim_branch: DataFrame) -> DataFrame:
    """The branches with the highest and the lowest revenue, one row."""
    order = F.struct("revenue", "branch")
    return _branch_revenue(orders_daily, dim_branch).agg(
        F.max_by("branch", order).alias("best"), F.min_by("branch", order).alias("worst")
    )


def revenue_distribution(orders_daily: DataFrame, dim_branch: DataFrame) -> DataFrame:
    """Each branch's part of all revenue, which is the sum of the branches' sums."""
    totals = orders_daily.groupBy("branch_key").agg(money_sum(F.col("total_net")).alias("revenue"))
    total = F.sum("revenue").over(Window.partitionBy(F.lit(1)))
    return (
        totals.withColumn("share", ratio(F.col("revenue"), total))
        .join(_branch_names(dim_branch), "branch_key")
        .select(F.col("branch_name").alias("branch"), "revenue", "share")
        .orderBy(pg_desc("revenue"), pg_asc("branch"))
    )


def daily_revenue(orders_daily: DataFrame, dim_branch: DataFrame) -> DataFrame:
    """Day and branch totals by date; a day's key says which date it is."""
    date = F.to_date(F.col("time_key").cast("string"), "yyyyMMdd")
    return (
        orders_daily.withColumn("sale_date", date)
        .join(dim_branch.select("branch_key", "branch_id"), "branch_key")
        .select(
            "sale_date",
            "branch_id",
            F.col("total_net").alias("revenue"),
            "total_discount",
            F.col("total_orders").alias("order_count"),
        )
    )


def product_performance(sales: DataFrame, dim_product: DataFrame) -> DataFrame:
    sold = sales.groupBy("product_key").agg(
        F.sum("quantity").alias("units_sold"), money_sum(F.col("net_amount")).alias("total_revenue")
    )
    return sold.join(dim_product, "product_key").select("name", "category", "units_sold", "total_revenue")
