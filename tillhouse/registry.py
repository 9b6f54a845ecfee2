"""The named queries over the tables of a scale-factor folder.

Each takes (spark, folder) and returns a DataFrame over whole tables. The
reference days lie in the data: warehouse, stock ledger and lots.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import explode_json_array
from .operators import (
    delete_cascade,
    delete_set_null,
    insert_absent,
    patch,
    replace_children,
    sanitize,
    snapshot_diff,
    upsert,
    validate,
    weighted_sample,
)
from .operators.rules import (
    accepted,
    duplicate_keys,
    inventory_rules,
    ledger_rules,
    missing_fields,
    rejected,
    user_rules,
)
from .plans import access, checks, dashboard, deltas, edits, features, ledger, olap_views, planning, pos, star, stores
from .schemas import LEDGER_TYPES, PRODUCT_JSON
from .session import configure
from .sources import DriverTables

AS_OF = dt.date(2001, 7, 31)
LEDGER_AS_OF = dt.datetime(2024, 1, 30, 23, 59, 59)
LOTS_AS_OF = dt.date(1998, 1, 1)
DAY = dt.timedelta(days=1)

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def present(df: DataFrame) -> DataFrame:
    """Plain output types: double for decimals, bigint for whole numbers, JSON
    text for lists, timestamps without zone."""

    def plain(field: T.StructField):
        c = F.col(f"`{field.name}`")
        kind = field.dataType
        if isinstance(kind, T.DecimalType):
            c = c.cast("double")
        elif isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        elif isinstance(kind, (T.ArrayType, T.StructType)):
            c = F.to_json(c)
        elif isinstance(kind, T.TimestampType):
            c = c.cast("timestamp_ntz")
        return c.alias(field.name)

    return df.select(*[plain(f) for f in df.schema.fields])


def query(fn: Callable[[DriverTables], DataFrame], days: tuple[dt.date, dt.date | None] | None = None) -> None:
    """Register ``fn`` under its name, less a trailing underscore that keeps it
    apart from an operator; ``days`` limits the orders it reads."""
    name = fn.__name__.rstrip("_")

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return present(fn(DriverTables(configure(spark), folder, days)))

    run.__name__ = name
    run.__doc__ = fn.__doc__
    _QUERIES[name] = run


def on_days(first: dt.date | None = None, last: dt.date | None = None):
    def register(fn):
        query(fn, None if first is None else (first, last))
        return fn

    return register


whole = on_days()
today_and_yesterday = on_days(AS_OF - DAY, AS_OF)
today_only = on_days(AS_OF, AS_OF)
two_weeks = on_days(AS_OF - 14 * DAY, None)


def _sales(t: DriverTables) -> DataFrame:
    return star.fact_sales(t.costed_items, t.orders, None, t.dim_branch, t.dim_product)


def _orders_daily(t: DriverTables) -> DataFrame:
    return star.fact_orders_daily(_sales(t))


def _rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), n) for c, n in digits.items()})


# ---- point of sale ----------------------------------------------------------


@whole
def pos_clean(t):
    return pos.clean(t.pos_events)


@whole
def pos_daily_sales(t):
    return pos.daily_sales(pos.clean(t.pos_events))


@whole
def ml_features(t):
    return features.ml_features(pos.daily_sales(pos.clean(t.pos_events)))


@whole
def ml_features_by_days(t):
    return features.ml_features(pos.daily_sales(pos.clean(t.pos_events)), by_days=True)


@whole
def spike_alerts(t):
    timed = t.pos_events.withColumn("event_ts", F.col("timestamp").try_cast("timestamp_ntz"))
    return pos.spike_alerts(timed, window="1 hour", threshold=20)


@whole
def kafka_normalize(t):
    return pos.normalized_rows(t.staged)


def _pos_lines(t):
    """Raw events as JSON text; lines of five units arrive cut off."""
    value = F.to_json(F.struct(*[F.col(c) for c in t.pos_events.columns]))
    cut = F.col("quantity") == 5
    return t.pos_events.select(F.when(cut, F.substring(value, 1, 15)).otherwise(value).alias("value"))


@whole
def pos_parsed(t):
    """The events that can be read from their text."""
    events = pos.parse_events(_pos_lines(t)).filter(F.col("transaction_id").isNotNull())
    return events.withColumn("timestamp", F.col("timestamp").try_cast("timestamp_ntz"))


@whole
def pos_malformed(t):
    """How many lines of each text cannot be read."""
    return pos.malformed(_pos_lines(t)).groupBy("value").agg(F.count(F.lit(1)).alias("lines"))


# ---- star schema ------------------------------------------------------------


@whole
def dim_time(t):
    return star.dim_time(t.order_times)


@whole
def dim_branch_upsert(t):
    """Load after the branches of region 0 were known under an older name."""
    old = t.raw("nation").filter(F.col("n_regionkey") == 0)
    dim = old.select(
        (F.col("n_nationkey") + 101).cast("long").alias("branch_key"),
        F.col("n_nationkey").alias("branch_id"),
        F.concat(F.lit("old "), F.col("n_name")).alias("name"),
        F.lit(dt.date(1995, 1, 1)).alias("valid_from"),
        F.lit(True).alias("is_current"),
    )
    source = t.branches.select(F.col("id").alias("branch_id"), "name")
    return star.upsert_dim(dim, source, "branch_id", "branch_key", ["name"])


def _old_branches(t):
    """The branches of region 0, as they were known under an older name."""
    old = t.raw("nation").filter(F.col("n_regionkey") == 0)
    return old.select(
        (F.col("n_nationkey") + 101).cast("long").alias("branch_key"),
        F.col("n_nationkey").cast("long").alias("branch_id"),
        F.concat(F.lit("old "), F.col("n_name")).alias("name"),
        F.lit(dt.date(1995, 1, 1)).alias("valid_from"),
        F.lit(True).alias("is_current"),
    )


@whole
def dim_branch_inferred(t):
    """Branches of region 0 and a placeholder for every other one that has orders."""
    return star.infer_members(_old_branches(t), t.order_headers, "branch_id", "branch_key")


@whole
def orders_of_inferred_branches(t):
    """Orders by branch, where only region 0 is known by name: none is lost for want of a
    dimension row."""
    dim = star.infer_members(_old_branches(t), t.order_headers, "branch_id", "branch_key")
    sold = t.order_headers.groupBy("branch_id").agg(F.count(F.lit(1)).alias("orders"))
    return sold.join(dim, "branch_id").select("branch_key", "name", "orders")


@whole
def dim_product_upsert(t):
    """Load after the products of two types were known, without a category."""
    known = t.products.filter(F.col("category").isin("ECONOMY", "SMALL"))
    dim = known.select(
        (F.col("id") * 2 + 1).alias("product_key"),
        F.col("id").alias("product_id"),
        F.upper("name").alias("name"),
        F.lit(None).cast("string").alias("category"),
        F.lit(dt.date(1995, 1, 1)).alias("valid_from"),
        F.lit(True).alias("is_current"),
    )
    source = t.products.select(F.col("id").alias("product_id"), "name", "category")
    return star.upsert_dim(dim, source, "product_id", "product_key", ["name", "category"])


@whole
def fact_sales(t):
    return _sales(t)


@whole
def fact_orders_daily(t):
    return _orders_daily(t)


@whole
def fact_orders_daily_incremental(t):
    """Daily totals of an older state, brought up to date by the changes of single orders.
    Of every ten orders, one is new since then, one had twice the amounts in another branch,
    and one has lost a twin that was deleted."""
    kind = F.col("order_id") % 10

    def line(part: str, sign: int, order=F.col("order_id"), branch=F.col("branch_key"), times: int = 1):
        amounts = [(F.col(c) * times).cast("decimal(18,2)").alias(c) for c in deltas.TOTALS.values()]
        keys = [F.lit(part).alias("part"), F.lit(sign).alias("sign"), order.alias("order_id"), branch.alias("branch_key")]
        return F.struct(*keys, *amounts)

    other = F.col("branch_key") % 25 + 1
    images = (
        F.when(kind == 3, F.array(line("change", 1)))
        .when(kind == 5, F.array(line("state", 1, branch=other, times=2), line("change", -1, branch=other, times=2), line("change", 1)))
        .when(kind == 7, F.array(line("state", 1), line("state", 1, -F.col("order_id")), line("change", -1, -F.col("order_id"))))
        .otherwise(F.array(line("state", 1)))
    )
    lines = _sales(t).select("time_key", F.explode(images).alias("image")).select("time_key", "image.*")
    return deltas.orders_daily(deltas.added_up(deltas.daily_sums(lines, "part").drop("part")))


@whole
def fact_inventory(t):
    return star.fact_inventory(t.inventory_logs, t.dim_branch, t.dim_product)


@whole
def fact_inventory_last(t):
    return star.fact_inventory(t.inventory_logs, t.dim_branch, t.dim_product, closing="last")


# ---- views ------------------------------------------------------------------


@whole
def revenue_by_hour(t):
    return olap_views.revenue_by_hour(_sales(t))


@whole
def top_products_branch(t):
    return olap_views.top_products_branch(_sales(t), t.dim_branch, t.dim_product)


def _turnover(t, fan_out):
    stock = star.fact_inventory(t.inventory_logs, t.dim_branch, t.dim_product)
    view = olap_views.inventory_turnover(_sales(t), stock, t.dim_branch, t.dim_product, fan_out=fan_out)
    return _rounded(view, avg_inventory=4, turnover_rate=4)


@whole
def inventory_turnover(t):
    return _turnover(t, fan_out=True)


@whole
def inventory_turnover_fixed(t):
    return _turnover(t, fan_out=False)


@whole
def profit_margin(t):
    return _rounded(olap_views.profit_margin(_orders_daily(t), t.dim_branch), profit_margin_percent=4)


@whole
def branch_performance(t):
    return olap_views.branch_performance(_orders_daily(t), t.dim_branch)


@whole
def branch_best_worst(t):
    return olap_views.branch_best_worst(_orders_daily(t), t.dim_branch)


@whole
def revenue_distribution(t):
    return _rounded(olap_views.revenue_distribution(_orders_daily(t), t.dim_branch), share=6)


@whole
def daily_revenue(t):
    return olap_views.daily_revenue(_orders_daily(t), t.dim_branch)


@whole
def product_performance(t):
    return olap_views.product_performance(_sales(t), t.dim_product)


# ---- dashboard --------------------------------------------------------------


@today_and_yesterday
def kpi(t):
    return dashboard.kpi(_sales(t), star.dim_time(t.order_times), t.dim_branch, t.dim_product, AS_OF)


@today_and_yesterday
def kpi_branch(t):
    sales, days = _sales(t), star.dim_time(t.order_times)
    return dashboard.kpi(sales, days, t.dim_branch, t.dim_product, AS_OF, branch_id=1)


@today_only
def kpi_revenue_by_hour(t):
    return dashboard.kpi_revenue_by_hour(_sales(t), t.dim_branch, AS_OF)


@two_weeks
def revenue_by_date(t):
    return dashboard.revenue_by_date(_sales(t), star.dim_time(t.order_times), t.dim_branch, AS_OF)


@two_weeks
def revenue_by_date_filled(t):
    by_date = dashboard.revenue_by_date(_sales(t), star.dim_time(t.order_times), t.dim_branch, AS_OF, branch_id=7)
    return dashboard.revenue_by_date_filled(by_date, AS_OF)


@whole
def top_products(t):
    return dashboard.top_products(_sales(t), t.dim_branch, t.dim_product)


@whole
def top_products_ranked(t):
    return dashboard.with_position(dashboard.top_products(_sales(t), t.dim_branch, t.dim_product, limit=10))


@whole
def top_products_of_branch(t):
    return dashboard.top_products(_sales(t), t.dim_branch, t.dim_product, limit=5, branch_id=3)


@whole
def low_stock_lots(t):
    return dashboard.low_stock_lots(t.lots, LOTS_AS_OF)


def _insights(t, as_of, stock):
    recent = DriverTables(t.spark, t.folder, (as_of - DAY, as_of))
    return dashboard.insights(_sales(recent), t.dim_branch, t.dim_product, stock, as_of)


@whole
def insights(t):
    return _insights(t, AS_OF, t.inventory_current)


@whole
def insights_quiet_day(t):
    """A day before the first order, with stock that no sale has touched."""
    full = t.inventory_current.withColumn("stock_level", F.col("stock_level") + 1_000_000_000)
    return _insights(t, dt.date(1990, 1, 2), full)


@whole
def data_quality(t):
    return checks.data_quality(t.inventory_current, t.order_items, t.order_times, _orders_daily(t))


# ---- orders and branch stock ------------------------------------------------


@whole
def order_totals(t):
    return ledger.order_totals(t.order_items)


@whole
def cost_price_default(t):
    return ledger.cost_price_default(t.products).select(F.col("id").alias("product_id"), "cost_price")


@whole
def stock_matrix_init(t):
    """Opening stock of the pairs that have sold nothing yet."""
    return ledger.stock_matrix_init(t.branches, t.products, t.consumption)


@whole
def stock_of_assortment(t):
    """Opening stock of what a branch has sold fifty units of, where it has no shelf stock left."""
    sold = t.consumption.filter("total_qty >= 50")
    return ledger.stock_of_assortment(sold, t.inventory_current.filter("stock_level > 0"))


@whole
def stock_after_consumption(t):
    return ledger.deplete(t.stock_matrix, t.consumption)


@whole
def inventory_change_log(t):
    return t.inventory_logs.select("branch_id", "product_id", "change_amount", "new_stock_level", "reason")


# ---- stores -----------------------------------------------------------------


@whole
def top_selling(t):
    return stores.top_selling(t.ledger, t.store_products)


@whole
def low_stock_items(t):
    return stores.low_stock_items(t.inventory, t.stores, t.store_products)


@whole
def low_stock_preview(t):
    return stores.low_stock_items(t.inventory, t.stores, t.store_products, limit=5)


@whole
def low_stock_by_ratio(t):
    return stores.low_stock_by_ratio(t.inventory, t.stores, t.store_products)


@whole
def inventory_list(t):
    return stores.inventory_list(t.inventory, t.stores, t.store_products)


@whole
def inventory_chart(t):
    return stores.stock_chart(t.inventory, t.stores, t.store_products)


@whole
def search(t):
    return stores.search(stores.inventory_list(t.inventory, t.stores, t.store_products), ["product", "category"], "Ring")


@whole
def inventory_by_store(t):
    return stores.inventory_by_store(t.inventory, t.stores)


@whole
def store_comparison(t):
    return _rounded(stores.store_comparison(t.inventory, t.stores), avg_quantity=4)


@whole
def category_breakdown(t):
    return _rounded(stores.category_breakdown(t.inventory, t.store_products), avg_stock=4)


@whole
def inventory_value(t):
    return stores.inventory_value(t.inventory, t.stores, t.store_products)


@whole
def store_kpi(t):
    return stores.store_kpi(t.stores, t.store_products, t.users, t.inventory, t.ledger, LEDGER_AS_OF)


@whole
def store_kpi_of_store(t):
    return stores.store_kpi(t.stores, t.store_products, t.users, t.inventory, t.ledger, LEDGER_AS_OF, store_id=4)


@whole
def product_list(t):
    return stores.product_list(t.store_products)


# ---- ledger -----------------------------------------------------------------


@whole
def transaction_summary(t):
    return _rounded(ledger.transaction_summary(t.ledger, LEDGER_AS_OF, days=20), avg_amount=4)


@whole
def sales_over_time(t):
    return ledger.sales_over_time(t.ledger, LEDGER_AS_OF)


@whole
def imports_over_time(t):
    return ledger.imports_over_time(t.ledger, LEDGER_AS_OF)


@whole
def sales_trend(t):
    return ledger.sales_trend(t.ledger, LEDGER_AS_OF)


@whole
def transactions_page(t):
    return ledger.transactions_page(t.ledger, t.stores, t.store_products, t.users, kind="sale", limit=20, offset=40)


@whole
def transactions_page_info(t):
    return ledger.transactions_page_info(t.ledger, t.stores, t.store_products, kind="sale", number=3, size=20)


@whole
def transaction_stats(t):
    return _rounded(ledger.transaction_stats(t.ledger), avg_change=4)


@whole
def ledger_balance(t):
    return ledger.ledger_balance(t.ledger, t.inventory).drop("created_at")


@whole
def ledger_balance_from_empty(t):
    return ledger.ledger_balance(t.ledger).drop("created_at")


@whole
def ledger_sync(t):
    return ledger.ledger_sync(t.inventory, t.ledger).select("store_id", "product_id", "quantity")


@whole
def stock_update_to_ledger(t):
    """The ledger rows behind setting all stock to its level after the ledger."""
    return ledger.sync_as_ledger_rows(t.inventory, t.ledger)


@whole
def inventory_upsert(t):
    """Set products to what the ledger imported of them, threshold 10."""
    imported = (
        t.ledger.filter(F.col("type") == "import")
        .groupBy("store_id", (F.col("product_id") * 50).alias("product_id"))
        .agg(F.sum("change_amount").alias("quantity"))
        .withColumn("low_stock", F.lit(10).cast("long"))
    )
    base = t.inventory.select("store_id", "product_id", "quantity", "low_stock")
    return upsert(base, imported, ["store_id", "product_id"], ["quantity", "low_stock"])


def _checked_edits(t):
    """Each ledger row as an edit that its user asks for; some name a threshold."""
    asked = t.ledger.select(
        "id", F.col("created_by").alias("user_id"), "store_id", (F.col("product_id") % 8).alias("product_id"),
        F.when(F.col("id") % 50 != 0, F.col("id") % 37).alias("quantity"),
        F.when(F.col("id") % 3 == 0, F.col("id") % 9).alias("low_stock"), "created_at",
    )
    return edits.checked(asked, t.users, t.roles)


@whole
def stock_edit_outcomes(t):
    """How many edits of each user pass the store check, and how many do not."""
    return _checked_edits(t).groupBy("user_id", "outcome").agg(F.count(F.lit(1)).alias("edits"))


@whole
def stock_edit_ledger(t):
    return edits.ledger_of_edits(t.inventory, _checked_edits(t))


@whole
def stock_after_edits(t):
    return edits.stock_after_edits(t.inventory, _checked_edits(t))


@whole
def stock_patch(t):
    """Recounts from the ledger's adjustments; only some name a new threshold."""
    n = F.count(F.lit(1))
    counted = (
        t.ledger.filter(F.col("type") == "adjustment")
        .groupBy((F.col("product_id") * 10 + F.col("store_id") - 1).alias("id"))
        .agg(n.alias("quantity"), F.when(n % 2 == 0, n * 3).alias("low_stock"))
    )
    return patch(t.inventory, counted, "id", ["quantity", "low_stock"])


# ---- people -----------------------------------------------------------------


@whole
def user_patch(t):
    return patch(t.users, t.user_changes, "id", ["name", "email", "role_id", "active"])


@whole
def user_list(t):
    return access.user_list(t.users, t.roles)


@whole
def role_permissions(t):
    return access.role_permissions(t.roles, t.role_permissions, t.permissions)


@whole
def permission_list(t):
    return access.permission_list(t.permissions)


@whole
def user_permissions(t):
    return access.user_permissions(t.users, t.roles, t.role_permissions, t.permissions)


@whole
def role_permission_replace(t):
    """Suppliers in debt get the permission numbered like their nation, and no other."""
    new = t.raw("supplier").filter(F.col("s_acctbal") < 1000).select(
        F.col("s_suppkey").alias("role_id"), F.col("s_nationkey").cast("long").alias("permission_id")
    )
    return replace_children(t.role_permissions, new, "role_id")


@whole
def delete_cascade_(t):
    """Grants left after the permissions with the highest numbers are deleted."""
    gone = t.permissions.filter(F.col("id") > 12)
    return delete_cascade(t.role_permissions, gone, "permission_id")


@whole
def delete_cascade_stock(t):
    """Ledger rows left after the stores of region 1 are deleted."""
    return delete_cascade(t.ledger, t.stores.filter(F.col("location") == "Region 1"), "store_id")


@whole
def delete_users_set_null(t):
    """Audit rows after inactive users are deleted."""
    return delete_set_null(t.audit_logs, t.users.filter(~F.col("active")), "user_id").select("id", "user_id", "action")


@whole
def visible_inventory(t):
    """What the administrator (user 10) and another user of that shift may see."""
    return access.visible_inventory(t.inventory, t.users, t.roles, [10, 11])


@whole
def visible_totals(t):
    return access.visible_totals(t.inventory, t.users, t.roles)


@whole
def user_role_lookup(t):
    """Role by e-mail, for twice the range of known addresses."""
    number = (F.col("c_custkey") * 2).cast("string")
    emails = t.raw("customer").select(F.concat(F.lit("user"), number, F.lit("@example.com")).alias("email"))
    return access.role_of(emails, access.normalize_profiles(t.raw_profiles))


@whole
def profile_normalize(t):
    return access.normalize_profiles(t.raw_profiles).drop("id")


@whole
def audit_log_search(t):
    first, last = dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 25)
    return access.audit_log_search(t.audit_logs, t.users, action="UPDATE", start=first, end=last, limit=50, offset=10)


@whole
def audit_capture(t):
    """Audit rows between the users and a later state: accounts in debt patched,
    the richest deleted, one account per supplier added."""
    rich = t.raw("customer").filter(F.col("c_acctbal") > 9000).select(F.col("c_custkey").alias("id"))
    added = t.raw("supplier").select(
        (-F.col("s_suppkey") - 1).alias("id"),
        F.col("s_name").alias("name"),
        F.lit(None).cast("string").alias("email"),
        F.lit(2).cast("long").alias("role_id"),
        (F.col("s_suppkey") % 10 + 1).alias("store_id"),
        F.lit(True).alias("active"),
    )
    patched = patch(t.users, t.user_changes, "id", ["name", "email", "role_id", "active"])
    after = delete_cascade(patched, rich, "id").unionByName(added)
    return snapshot_diff(t.users, after, "id", "users")


# ---- lists and look-ups ------------------------------------------------------


@whole
def branch_list(t):
    return stores.branch_list(t.branches)


@whole
def store_list(t):
    return stores.store_list(t.stores)


@whole
def transaction_by_id(t):
    return ledger.transaction_by_id(t.ledger, t.stores, t.store_products, t.users, 77)


@whole
def transactions_page_after(t):
    last = (dt.datetime(2024, 1, 20), 500)
    return ledger.transactions_page_after(t.ledger, t.stores, t.store_products, t.users, kind="sale", limit=30, last=last)


@whole
def permissions_of_role(t):
    return access.permissions_of_role(t.role_permissions, t.permissions, 3)


# ---- cleaning, loading, planning ---------------------------------------------


@whole
def validate_ledger_rows(t):
    """Ledger entries as typed in: imports under an unknown name, some without a product."""
    entries = t.ledger.withColumns(
        {
            "type": F.when(F.col("type") == "import", "delivery").otherwise(F.col("type")),
            "product_id": F.when(F.col("product_id") != 9, F.col("product_id")),
        }
    )
    return validate(entries, ledger_rules(LEDGER_TYPES)).select("id", "errors")


@whole
def missing_sign_up_fields(t):
    return missing_fields(t.sign_ups, ["name", "email", "role_id"]).select("id", "missing")


@whole
def accepted_sign_ups(t):
    return accepted(validate(t.sign_ups, user_rules())).select("id", "email")


@whole
def rejected_sign_ups(t):
    """How often each message turned a form down."""
    told = rejected(validate(t.sign_ups, user_rules())).select(F.explode("errors").alias("error"))
    return told.groupBy("error").agg(F.count(F.lit(1)).alias("forms"))


@whole
def duplicate_part_names(t):
    return duplicate_keys(t.raw("part"), ["p_name", "p_brand"])


@whole
def uniqueness_report(t):
    """The uniqueness constraints of the operational tables, one row each."""
    kept = [
        checks.uniqueness(t.branches, ["name"], "branches"),
        checks.uniqueness(t.products, ["name"], "products"),
        checks.uniqueness(t.inventory, ["store_id", "product_id"], "inventory"),
        checks.uniqueness(t.inventory_current, ["branch_id", "product_id"], "inventory_current"),
        checks.uniqueness(t.pos_events, ["transaction_id"], "raw events"),
        checks.uniqueness(t.staged, ["transaction_id"], "staged events"),
        checks.uniqueness(t.raw("lineitem"), ["l_orderkey", "l_linenumber"], "order lines"),
    ]
    report = kept[0]
    for more in kept[1:]:
        report = report.unionByName(more)
    return report


@whole
def validate_rows(t):
    return validate(t.sign_ups, user_rules()).select("id", "errors")


@whole
def validate_inventory_rows(t):
    return validate(t.stock_forms, inventory_rules())


@whole
def sanitize_strings(t):
    return sanitize(t.raw("pages"))


@whole
def json_array_load(t):
    """New catalogue names of the uploads; those of one type are known already."""
    known = t.products.filter(F.col("category") == "ECONOMY").select("name")
    entries = explode_json_array(t.product_payloads, "payload", PRODUCT_JSON, position="position")
    return ledger.seed_products(known, entries)


@whole
def insert_absent_stock(t):
    """Stock rows to add for ledger keys that have none, first row per key."""
    keyed = t.ledger.withColumn("product_id", F.col("product_id") * 50)
    new = keyed.select("store_id", "product_id", "change_amount", "id")
    return insert_absent(t.inventory, new, ["store_id", "product_id"], order=["id"])


@whole
def date_volume_plan(t):
    """Plan over the whole order history at its mean daily volume."""
    day = F.to_date("created_at")
    history = t.order_times.agg(
        F.min(day).alias("first"), F.max(day).alias("last"), F.count(F.lit(1)).alias("n")
    )
    span = F.datediff("last", "first") + 1
    mean = F.call_function("div", F.col("n"), span.cast("long"))
    return planning.date_volume_plan(history, F.col("first"), F.col("last"), mean)


@whole
def weighted_sample_(t):
    """Three products per type, the popular ones more often."""
    picked = weighted_sample(t.products, "popularity_weight", 3, ["category"], key="id", seed=7)
    return picked.select("category", "id", "pick_rank")


def queries() -> dict[str, Query]:
    return dict(_QUERIES)
