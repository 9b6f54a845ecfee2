"""Dashboard figures for a reference day.

``sales`` should hold little more than the days in question: read it from a
``fact_sales`` table partitioned by ``time_key``, or build it from orders of
those days. The functions filter again, so a longer history gives the same.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import all_of, hour_label, money_sum, percent_change, pg_asc, pg_desc


def day_key(day: dt.date) -> int:
    return int(day.strftime("%Y%m%d"))


def _of_branch(sales: DataFrame, dim_branch: DataFrame, branch_id: int | None) -> DataFrame:
    """Sales of one branch; any falsy id means all branches."""
    if not branch_id:
        return sales
    key = dim_branch.filter(F.col("branch_id") == branch_id).select("branch_key").scalar()
    return sales.filter(F.col("branch_key") == key)


def kpi(
    sales: DataFrame, dim_time: DataFrame, dim_branch: DataFrame, dim_product: DataFrame,
    as_of: dt.date, branch_id: int | None = None,
) -> DataFrame:
    """Key figures of the day, one row, also when there are no sales.

    ``avg_order_value`` averages order lines, as the source dashboard does;
    ``avg_order_value_true`` divides revenue by orders. One pass over the sales
    gives per-order and per-product sums side by side.
    """
    today, yesterday = day_key(as_of), day_key(as_of - dt.timedelta(days=1))
    scoped = _of_branch(sales, dim_branch, branch_id).filter(F.col("time_key").isin(today, yesterday))
    known = dim_time.filter(F.col("time_key") == today).select("time_key").exists()
    is_today = F.col("time_key") == today
    counted = is_today & known

    sums = scoped.groupingSets([["order_id"], ["product_key"]], "order_id", "product_key").agg(
        (F.grouping("order_id") == 0).alias("_by_order"),
        F.sum(F.when(counted, F.col("net_amount"))).alias("_today"),
        F.count(F.when(counted, F.col("net_amount"))).alias("_priced"),
        F.count(F.when(counted, F.lit(1))).alias("_lines"),
        F.sum(F.when(~is_today, F.col("net_amount"))).alias("_yesterday"),
        F.sum(F.when(is_today, F.col("quantity"))).alias("_units"),
    )
    by_order, zero = F.col("_by_order"), F.lit(0).cast("decimal(38,2)")

    def total(column: str) -> Column:
        return F.coalesce(F.sum(F.when(by_order, F.col(column))), zero)

    best = F.when(~by_order & F.col("_units").isNotNull(), F.struct(F.col("_units"), -F.col("product_key")))
    figures = sums.agg(
        total("_today").alias("_today"),
        F.count_if(by_order & (F.col("_lines") > 0)).alias("orders_today"),
        F.coalesce(F.sum(F.when(by_order, F.col("_priced"))), F.lit(0)).alias("_priced"),
        total("_yesterday").alias("_yesterday"),
        (-F.max(best).getField("col2")).alias("_best"),
    )

    def average(count: str) -> Column:
        mean = F.col("_today").cast("double") / F.nullif(F.col(count).cast("double"), F.lit(0.0))
        return F.round(F.coalesce(mean, F.lit(0.0)), 2)

    names = dim_product.select("product_key", "name")
    return figures.join(names, F.col("_best") == F.col("product_key"), "left").select(
        F.round("_today", 2).alias("revenue_today"),
        "orders_today",
        average("_priced").alias("avg_order_value"),
        average("orders_today").alias("avg_order_value_true"),
        F.round("_yesterday", 2).alias("revenue_yesterday"),
        F.round(percent_change(F.col("_today"), F.col("_yesterday")), 1).alias("revenue_trend_pct"),
        F.coalesce("name", F.lit("N/A")).alias("top_product"),
    )


def kpi_revenue_by_hour(
    sales: DataFrame, dim_branch: DataFrame, as_of: dt.date, branch_id: int | None = None
) -> DataFrame:
    today = _of_branch(sales, dim_branch, branch_id).filter(F.col("time_key") == day_key(as_of))
    per_order = today.groupBy("hour_of_day", "order_id").agg(money_sum(F.col("net_amount")).alias("net"))
    return (
        per_order.groupBy("hour_of_day")
        .agg(money_sum(F.col("net")).alias("revenue"), F.count("order_id").alias("orders"))
        .orderBy(pg_asc("hour_of_day"))
        .select(hour_label(F.col("hour_of_day")).alias("hour"), F.round("revenue", 2).alias("revenue"), "orders")
    )


def revenue_by_date(
    sales: DataFrame, dim_time: DataFrame, dim_branch: DataFrame,
    as_of: dt.date, days: int = 14, branch_id: int | None = None,
) -> DataFrame:
    """Revenue per day since ``days`` before ``as_of``. Days without sales are missing."""
    first = as_of - dt.timedelta(days=days)
    recent = _of_branch(sales, dim_branch, branch_id).filter(F.col("time_key") >= day_key(first))
    per_order = recent.groupBy("time_key", "order_id").agg(money_sum(F.col("net_amount")).alias("net"))
    daily = per_order.groupBy("time_key").agg(money_sum(F.col("net")).alias("revenue"), F.count("order_id").alias("orders"))
    dates = dim_time.filter(F.col("full_date") >= F.lit(first)).select("time_key", F.col("full_date").alias("date"))
    return daily.join(dates, "time_key").select("date", "revenue", "orders").orderBy(pg_asc("date"))


def revenue_by_date_filled(by_date: DataFrame, as_of: dt.date, days: int = 14) -> DataFrame:
    """The same with a zero row for each day without sales. The spine runs from
    the first day of the range to ``as_of``, or to the last sale if that is later."""
    # A few days: they go into one row, which the spine is made from and looked up in.
    known = by_date.agg(
        F.max("date").alias("_last"),
        F.map_from_entries(F.collect_list(F.struct("date", F.struct("revenue", "orders")))).alias("_known"),
    )
    spine = F.sequence(
        F.lit(as_of - dt.timedelta(days=days)), F.greatest("_last", F.lit(as_of)), F.expr("interval 1 day")
    )
    found = F.try_element_at("_known", F.col("date"))
    return (
        known.select("_known", F.explode(spine).alias("date"))
        .select(
            "date",
            F.coalesce(found["revenue"], F.lit(0).cast("decimal(12,2)")).alias("revenue"),
            F.coalesce(found["orders"], F.lit(0)).alias("orders"),
        )
        .orderBy(pg_asc("date"))
    )


def top_products(
    sales: DataFrame, dim_branch: DataFrame, dim_product: DataFrame, limit: int = 5, branch_id: int | None = None
) -> DataFrame:
    """Best sellers by units, in order; products without a dimension row do not count."""
    sold = (
        _of_branch(sales, dim_branch, branch_id)
        .groupBy("product_key")
        .agg(F.sum("quantity").alias("units_sold"), money_sum(F.col("net_amount")).alias("revenue"))
    )
    return (
        sold.join(dim_product, "product_key")
        .orderBy(pg_desc("units_sold"), pg_asc("product_key"))
        .limit(limit)
        .select("name", "category", "units_sold", F.round("revenue", 2).alias("revenue"))
    )


def with_position(best: DataFrame) -> DataFrame:
    """Number the rows of a short ranked list, by units and then by name."""
    order = Window.orderBy(pg_desc("units_sold"), pg_asc("name"))
    return best.withColumn("position", F.row_number().over(order))


def low_stock_lots(lots: DataFrame, as_of: dt.date, branch_id: int | None = None, soon_days: int = 7) -> DataFrame:
    """Lots at or below their reorder level, or expiring within a week.

    Critical: at half the reorder level or less, or expired.
    """
    zero = F.lit(0).cast("decimal(10,2)")
    stock, reorder = F.coalesce("stock_quantity", zero), F.coalesce("reorder_level", zero)
    expiry = F.col("expiry_date")
    expiring = expiry.isNotNull() & (expiry <= F.lit(as_of + dt.timedelta(days=soon_days)))
    expired = F.coalesce(expiry <= F.lit(as_of), F.lit(False))
    scope = F.col("branch_id") == branch_id if branch_id else None
    return (
        lots.filter(all_of([(stock <= reorder) | expiring, scope]))
        .orderBy(pg_asc("expiry_date"), pg_asc("stock_quantity"), pg_asc("batch_number"), pg_asc("product_name"))
        .select(
            F.col("product_name").alias("product"),
            F.col("ingredient_type").alias("category"),
            stock.alias("stock"),
            "unit",
            reorder.alias("reorder_level"),
            "expiry_date",
            F.col("batch_number").alias("batch"),
            F.when((stock * 2 <= reorder) | expired, "critical").otherwise("warning").alias("severity"),
        )
    )


# Insight texts and limits as the dashboard shows them.
DROP_TEXT = "Branch %s revenue dropped %.1f%% so với hôm qua"
SURGE_TEXT = "Branch %s revenue surged %.1f%% so với hôm qua"
PEAK_TEXT = "Peak hours today: %s"
LOW_TEXT = "%d product(s) are running low on stock across all branches"
BEST_TEXT = "Best seller today: %s (%d units)"
NOTHING_TEXT = "No significant data insights for today."
DROP_PERCENT, SURGE_PERCENT, LOW_LEVEL, PEAK_HOURS = -15, 20, 20, 2


def insights(
    sales: DataFrame, dim_branch: DataFrame, dim_product: DataFrame, stock: DataFrame, as_of: dt.date
) -> DataFrame:
    """Remarks on the day, as (type, text): branches by key, peak hours, low stock,
    best seller.

    Branch, hour and product sums come from one pass over the two days' sales. The
    remarks, at most one per branch and three more, are put in order in one row.
    """
    today, yesterday = day_key(as_of), day_key(as_of - dt.timedelta(days=1))
    is_today = F.col("time_key") == today
    net, zero = F.col("net_amount"), F.lit(0).cast("decimal(12,2)")
    sums = (
        sales.filter(F.col("time_key").isin(today, yesterday))
        .groupingSets(
            [["branch_key"], ["hour_of_day"], ["product_key"]], "branch_key", "hour_of_day", "product_key"
        )
        .agg(
            F.grouping_id().alias("_set"),
            F.sum(F.when(is_today, net).otherwise(zero)).alias("_today"),
            F.sum(F.when(is_today, zero).otherwise(net)).alias("_yesterday"),
            F.sum(F.when(is_today, F.col("quantity"))).alias("_units"),
        )
    )
    of_branch, of_hour, of_product = (F.col("_set") == 3, F.col("_set") == 5, F.col("_set") == 6)
    sold_today = F.col("_units").isNotNull()
    # One row per branch, one for the hours of the day (at most 24) and one for the best product.
    hour = F.when(of_hour & sold_today, F.struct((-F.col("_today")).alias("r"), F.col("hour_of_day").alias("h")))
    best = F.when(of_product & sold_today, F.struct(F.col("_units").alias("u"), (-F.col("product_key")).alias("p")))
    rows = sums.groupBy("_set", F.when(of_branch, F.col("branch_key")).alias("branch_key")).agg(
        F.sum(F.when(of_branch, F.col("_today"))).alias("_today"),
        F.sum(F.when(of_branch, F.col("_yesterday"))).alias("_yesterday"),
        F.sort_array(F.collect_list(hour)).alias("_hours"),
        F.max(best).alias("_best"),
    )
    names = dim_branch.select("branch_key", F.col("name").alias("_branch"))
    products = dim_product.select(F.col("product_key").alias("_pk"), F.col("name").alias("_product"))
    labelled = rows.join(names, "branch_key", "left").join(products, F.col("_pk") == -F.col("_best.p"), "left")

    percent = percent_change(F.col("_today"), F.col("_yesterday"))
    shown = F.round(F.abs(percent), 1)
    compared = of_branch & (F.col("_yesterday") > 0)
    peaks = F.transform(F.slice("_hours", 1, PEAK_HOURS), lambda x: hour_label(x["h"]))
    hours_known = of_hour & (F.size("_hours") > 0)
    best_known = of_product & F.col("_best").isNotNull()
    dropped, surged = compared & (percent <= DROP_PERCENT), compared & (percent >= SURGE_PERCENT)
    at = F.when(compared, 0).when(hours_known, 1).when(best_known, 3)
    from_sales = labelled.select(
        at.alias("at"),
        "branch_key",
        F.when(dropped, "warning").when(surged, "success").when(hours_known | best_known, "info").alias("type"),
        F.when(dropped, F.format_string(DROP_TEXT, "_branch", shown))
        .when(surged, F.format_string(SURGE_TEXT, "_branch", shown))
        .when(hours_known, F.format_string(PEAK_TEXT, F.array_join(peaks, " and ")))
        .when(best_known, F.format_string(BEST_TEXT, "_product", "_best.u"))
        .alias("text"),
    ).filter(F.col("type").isNotNull())

    low = stock.filter(F.col("stock_level") < LOW_LEVEL).agg(F.count(F.lit(1)).alias("_n"))
    from_stock = low.filter(F.col("_n") > 0).select(
        F.lit(2).alias("at"),
        F.lit(None).cast("long").alias("branch_key"),
        F.lit("warning").alias("type"),
        F.format_string(LOW_TEXT, "_n").alias("text"),
    )
    remark = F.struct("at", "branch_key", "type", "text")
    found = from_sales.unionByName(from_stock).agg(F.sort_array(F.collect_list(remark)).alias("all"))
    nothing = F.array(
        F.struct(
            F.lit(0).alias("at"), F.lit(None).cast("long").alias("branch_key"),
            F.lit("info").alias("type"), F.lit(NOTHING_TEXT).alias("text"),
        )
    )
    remarks = F.when(F.size("all") > 0, F.col("all")).otherwise(nothing)
    return found.select(F.explode(remarks).alias("remark")).select("remark.type", "remark.text")
