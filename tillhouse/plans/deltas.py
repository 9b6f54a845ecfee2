"""Daily order totals kept up to date by the changes of single orders.

Totals are sums over orders, so a changed order takes back what its old lines gave and
adds what its new ones give; an inserted order only adds, a deleted one only takes back.
Beside each sum goes the number of orders that have a value for it, so that a total of
nothing becomes NULL again, as in a full load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import money_sum

KEYS = ["time_key", "branch_key"]
TOTALS = {"total_gross": "gross_amount", "total_discount": "discount_amount", "total_net": "net_amount", "total_cost": "cost_amount"}
KNOWN = {total: total.replace("total", "known") for total in TOTALS}


def daily_sums(lines: DataFrame, *more: str) -> DataFrame:
    """Signed totals of fact lines with a ``sign`` of 1 or -1, per day and branch (and
    ``more``). Lines are summed per order first, as for the fact itself."""
    sums = [money_sum(F.col(c)).alias(c) for c in TOTALS.values()]
    orders = lines.groupBy(*more, *KEYS, "order_id", "sign").agg(*sums)
    amounts = [money_sum(F.col(c) * F.col("sign")).alias(total) for total, c in TOTALS.items()]
    known = [F.sum(F.when(F.col(c).isNotNull(), F.col("sign")).otherwise(0)).alias(KNOWN[total]) for total, c in TOTALS.items()]
    return orders.groupBy(*more, *KEYS).agg(F.sum("sign").alias("total_orders"), *amounts, *known)


def state_of(sales: DataFrame) -> DataFrame:
    """The totals of a whole fact, ready for changes to be added."""
    return added_up(daily_sums(sales.withColumn("sign", F.lit(1))))


def change_of(old_lines: DataFrame, new_lines: DataFrame) -> DataFrame:
    """What changed orders do to the totals: their lines before and after."""
    columns = [*KEYS, "order_id", *TOTALS.values()]
    before = old_lines.select(*columns, F.lit(-1).alias("sign"))
    return daily_sums(before.unionByName(new_lines.select(*columns, F.lit(1).alias("sign"))))


def added_up(sums: DataFrame) -> DataFrame:
    """Totals and changes put together; days and branches left without orders go."""
    added = sums.groupBy(*KEYS).agg(
        F.sum("total_orders").cast("long").alias("total_orders"),
        *[money_sum(F.coalesce(F.col(t), F.lit(0))).alias(t) for t in TOTALS],
        *[F.sum(k).cast("long").alias(k) for k in KNOWN.values()],
    )
    totals = {t: F.when(F.col(k) > 0, F.col(t)) for t, k in KNOWN.items()}
    return added.filter(F.col("total_orders") > 0).withColumns(totals)


def orders_daily(state: DataFrame) -> DataFrame:
    """The columns of ``fact_orders_daily``."""
    return state.select(*KEYS, "total_orders", *TOTALS)
