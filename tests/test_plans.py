"""Star schema, dashboard, access and quality on small hand-made tables."""

import datetime as dt
import math
import random
from decimal import Decimal
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tillhouse.plans import access, checks, dashboard, edits, ledger, olap_views, star, stores
from tillhouse.registry import queries
from tillhouse.sources import DriverTables

FOLDER = "/root/testdata/sf0.001"
DAY = dt.date(2026, 4, 20)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def shop(spark):
    """Two branches, three products; order 4 is free, order 5 has no items."""
    branches = spark.createDataFrame([(1, "North", 3), (2, "South", 1)], "id long, name string, traffic_weight int")
    products = spark.createDataFrame(
        [(1, "Tea", "Drink", Decimal("4.50"), None), (2, "Cake", "Food", Decimal("3.00"), Decimal("0.00")), (3, "Cup", "Shop", Decimal("0.00"), Decimal("1.00"))],
        "id long, name string, category string, base_price decimal(10,2), cost_price decimal(10,2)",
    )
    items = spark.createDataFrame(
        [(1, 1, 2, "4.50", "0.00"), (1, 2, 1, "3.00", "1.00"), (2, 2, 3, "3.00", "0.00"), (3, 1, 10, "4.50", "0.00"), (4, 3, 1, "0.00", "0.00")],
        "order_id long, product_id long, quantity int, unit_price string, discount string",
    ).withColumns({c: F.col(c).cast("decimal(10,2)") for c in ("unit_price", "discount")})
    headers = spark.createDataFrame(
        [(1, 1, "2026-04-20 09:15:00"), (2, 1, "2026-04-19 12:00:00"), (3, 2, "2026-04-20 12:30:00"), (4, 2, "2026-04-20 09:00:00"), (5, 2, "2026-04-20 23:00:00")],
        "id long, branch_id long, t string",
    ).selectExpr("id", "branch_id", "CAST(t AS timestamp_ntz) AS created_at")
    totals = ledger.order_totals(items).withColumnRenamed("order_id", "id")
    orders = headers.join(totals, "id", "left").fillna(0)
    dim_branch = branches.select((F.col("id") * 10).alias("branch_key"), F.col("id").alias("branch_id"), "name")
    dim_product = products.select((F.col("id") * 100).alias("product_key"), F.col("id").alias("product_id"), "name", "category")
    sales = star.fact_sales(items, orders, ledger.cost_price_default(products), dim_branch, dim_product)
    return SimpleNamespace(
        branches=branches, products=products, items=items, orders=orders, headers=headers,
        dim_branch=dim_branch, dim_product=dim_product, dim_time=star.dim_time(headers), sales=sales,
        daily=star.fact_orders_daily(sales),
    )


def test_fact_sales_apportions_discount(shop):
    found = {(r.order_id, r.product_key): (r.gross_amount, r.discount_amount, r.net_amount, r.cost_amount) for r in shop.sales.collect()}
    d = Decimal
    assert found[1, 100] == (d("9.00"), d("0.75"), d("8.25"), d("3.60"))
    assert found[1, 200] == (d("3.00"), d("0.25"), d("2.75"), d("1.20"))
    assert found[4, 300] == (d("0.00"), None, None, d("1.00"))
    assert len(found) == 5


def test_dim_time_is_padded_and_incremental(shop):
    by_day = {r.full_date: r for r in shop.dim_time.collect()}
    sunday = by_day[dt.date(2026, 4, 19)]
    assert (sunday.time_key, sunday.day_of_week, sunday.day_name, sunday.month_name, sunday.quarter, sunday.is_weekend) == (
        20260419, 7, "Sunday   ", "April    ", 2, True,
    )
    known = shop.dim_time.filter("full_date = DATE'2026-04-19'")
    assert [r.full_date for r in star.dim_time(shop.headers, known).collect()] == [DAY]


def test_dim_upsert_is_stable(spark, shop):
    dim = spark.createDataFrame([(7, 2, "Old", "2020")], "branch_key long, branch_id long, name string, valid_from string")
    source = shop.branches.select(F.col("id").alias("branch_id"), "name")
    once = star.upsert_dim(dim, source, "branch_id", "branch_key", ["name"])
    assert rows(once) == [(7, 2, "South", "2020"), (8, 1, "North", None)]
    assert rows(star.upsert_dim(once, source, "branch_id", "branch_key", ["name"])) == rows(once)


def test_kpi(shop):
    row = dashboard.kpi(shop.sales, shop.dim_time, shop.dim_branch, shop.dim_product, DAY).first().asDict()
    assert {k: float(v) if isinstance(v, Decimal) else v for k, v in row.items()} == {
        "revenue_today": 56.0,
        "orders_today": 3,
        "avg_order_value": round(56 / 3, 2),
        "avg_order_value_true": round(56 / 3, 2),
        "revenue_yesterday": 9.0,
        "revenue_trend_pct": 522.2,
        "top_product": "Tea",
    }
    one = dashboard.kpi(shop.sales, shop.dim_time, shop.dim_branch, shop.dim_product, DAY, branch_id=1).first()
    assert (float(one.revenue_today), one.orders_today, one.avg_order_value, one.avg_order_value_true) == (11.0, 1, 5.5, 11.0)


def test_kpi_without_sales(shop):
    row = dashboard.kpi(shop.sales, shop.dim_time, shop.dim_branch, shop.dim_product, dt.date(2020, 1, 1)).first()
    assert tuple(map(str, row)) == ("0.00", "0", "0.0", "0.0", "0.00", "0.0", "N/A")
    unknown = dashboard.kpi(shop.sales, shop.dim_time, shop.dim_branch, shop.dim_product, DAY, branch_id=99).first()
    assert unknown.orders_today == 0 and unknown.top_product == "N/A"


def test_hours_and_dates(shop):
    hours = rows(dashboard.kpi_revenue_by_hour(shop.sales, shop.dim_branch, DAY))
    assert hours == [("09:00", Decimal("11.00"), 2), ("12:00", Decimal("45.00"), 1)]
    by_date = dashboard.revenue_by_date(shop.sales, shop.dim_time, shop.dim_branch, DAY, days=2)
    filled = rows(dashboard.revenue_by_date_filled(by_date, DAY, days=2))
    assert [(r[0].day, float(r[1]), r[2]) for r in filled] == [(18, 0.0, 0), (19, 9.0, 1), (20, 56.0, 3)]
    empty = dashboard.revenue_by_date_filled(by_date.limit(0), DAY, days=1)
    assert [float(r.revenue) for r in empty.collect()] == [0.0, 0.0]


def test_insights(spark, shop):
    stock = spark.createDataFrame([(1, 1, 19), (1, 2, 20)], "branch_id long, product_id long, stock_level long")
    found = [tuple(r) for r in dashboard.insights(shop.sales, shop.dim_branch, shop.dim_product, stock, DAY).collect()]
    assert found == [
        ("success", "Branch North revenue surged 22.2% so với hôm qua"),
        ("info", "Peak hours today: 12:00 and 09:00"),
        ("warning", "1 product(s) are running low on stock across all branches"),
        ("info", "Best seller today: Tea (12 units)"),
    ]
    dropped = rows(dashboard.insights(shop.sales, shop.dim_branch, shop.dim_product, stock.limit(0), DAY + dt.timedelta(days=1)))
    assert dropped == [
        ("warning", "Branch North revenue dropped 100.0% so với hôm qua"),
        ("warning", "Branch South revenue dropped 100.0% so với hôm qua"),
    ]
    quiet = dashboard.insights(shop.sales, shop.dim_branch, shop.dim_product, stock.limit(0), dt.date(2020, 1, 1))
    assert rows(quiet) == [("info", "No significant data insights for today.")]


def test_turnover_fan_out_equals_the_join(spark, shop):
    stock = spark.createDataFrame(
        [(20260419, 10, 100, 0, 0, 4), (20260420, 10, 100, 0, 0, 6), (20260420, 10, 200, 0, 0, 0)],
        "time_key int, branch_key long, product_key long, total_restocked long, total_consumed long, closing_stock long",
    )
    found = {r[:2]: r[2:] for r in map(tuple, olap_views.inventory_turnover(shop.sales, stock, shop.dim_branch, shop.dim_product).collect())}
    assert found["North", "Tea"] == (Decimal("7.20"), 5.0, 1.44)
    assert found["North", "Cake"] == (Decimal("4.80"), 0.0, None)
    assert found["South", "Tea"] == (Decimal("18.00"), 1.0, None)
    once = olap_views.inventory_turnover(shop.sales, stock, shop.dim_branch, shop.dim_product, fan_out=False)
    assert {r[:2]: r[2] for r in map(tuple, once.collect())}["North", "Tea"] == Decimal("3.60")


def test_margin_of_branch_without_net(shop):
    found = {(r.time_key, r.branch_name): r for r in olap_views.profit_margin(shop.daily, shop.dim_branch).collect()}
    assert round(found[20260420, "North"].profit_margin_percent, 4) == round((11 - 4.8) / 11 * 100, 4)
    free = shop.daily.withColumn("total_net", F.lit(0).cast("decimal(12,2)"))
    assert {r.profit_margin_percent for r in olap_views.profit_margin(free, shop.dim_branch).collect()} == {0.0}


def test_low_stock_lots(spark):
    d = dt.date
    lots = spark.createDataFrame(
        [
            (1, "a", "x", None, "kg", None, None, "1"),  # unknown counts as 0 <= 0, and as half of 0
            (1, "b", "x", Decimal(8), "kg", Decimal(10), None, "2"),
            (1, "c", "x", Decimal(5), "kg", Decimal(10), None, "3"),
            (1, "d", "x", Decimal(50), "kg", Decimal(10), d(2026, 4, 27), "4"),
            (1, "e", "x", Decimal(50), "kg", Decimal(10), d(2026, 4, 20), "5"),
            (2, "f", "x", Decimal(50), "kg", Decimal(10), d(2026, 4, 28), "6"),
        ],
        "branch_id int, product_name string, ingredient_type string, stock_quantity decimal(10,2), unit string,"
        "reorder_level decimal(10,2), expiry_date date, batch_number string",
    )
    found = [(r.product, r.severity) for r in dashboard.low_stock_lots(lots, DAY).collect()]
    assert found == [("e", "critical"), ("d", "warning"), ("c", "critical"), ("b", "warning"), ("a", "critical")]
    assert dashboard.low_stock_lots(lots, DAY, branch_id=2).count() == 0


def test_data_quality(spark, shop):
    stock = spark.createDataFrame([(1, 1, -1)], "branch_id long, product_id long, stock_level long")
    lost = shop.items.limit(1).withColumn("order_id", F.lit(999).cast("long"))
    bad = rows(checks.data_quality(stock, shop.items.unionByName(lost), shop.orders, shop.daily.withColumn("total_orders", F.lit(10001))))
    assert [(r[0], r[1]) for r in bad] == [
        ("Abnormal Spike Check", "WARNING"), ("FK Integrity (Order Items)", "FAILED"), ("Negative Stock Check", "FAILED"),
    ]
    empty = rows(checks.data_quality(stock.limit(0), shop.items.limit(0), shop.orders, shop.daily.limit(0)))
    assert [r[1] for r in empty] == ["PASSED"] * 3
    assert empty[0][2] == "Max orders/day is 0, within normal limits."
    assert checks.uniqueness(shop.branches, ["id"], "branches").first().status == "PASSED"


# The seeded roles, permissions and their matrix, plus a role with none.
MATRIX = {
    "admin": ["view_dashboard", "manage_inventory", "manage_users", "manage_roles"],
    "manager": ["view_dashboard", "manage_inventory"],
    "staff": ["view_dashboard"],
    "guest": [],
}


def test_access(spark):
    keys = MATRIX["admin"]
    roles = spark.createDataFrame([(i, n, n) for i, n in enumerate(MATRIX, 1)], "id long, name string, description string")
    permissions = spark.createDataFrame([(i, k, k) for i, k in enumerate(keys, 1)], "id long, key string, label string")
    pairs = [(i, keys.index(k) + 1) for i, n in enumerate(MATRIX, 1) for k in MATRIX[n]]
    bridge = spark.createDataFrame(pairs, "role_id long, permission_id long")
    users = spark.createDataFrame(
        [(1, 1, 1, True), (2, 2, 1, True), (3, 3, 2, False), (4, 4, 2, True), (5, 3, 9, True)],
        "id long, role_id long, store_id long, active boolean",
    )
    found = {r.name: r.permissions for r in access.role_permissions(roles, bridge, permissions).collect()}
    assert found == {n: sorted(p) for n, p in MATRIX.items()}
    mine = {r.user_id: r.permissions for r in access.user_permissions(users, roles, bridge, permissions).collect()}
    assert mine == {1: sorted(keys), 2: sorted(MATRIX["manager"]), 5: ["view_dashboard"]}
    assert access.permissions_of_role(bridge, permissions, 2).count() == 2

    stock = spark.createDataFrame([(1, 1, 5), (2, 1, 6), (3, 2, 7)], "id long, store_id long, quantity long")
    assert [access.visible_to(stock, users, roles, u).count() for u in (1, 2, 4, 5, 99)] == [3, 2, 1, 0, 0]
    of_all = access.visible_inventory(stock, users, roles, [1, 2, 4, 5, 99]).groupBy("user_id").count().collect()
    assert {r.user_id: r["count"] for r in of_all} == {1: 3, 2: 2, 4: 1}
    homeless = spark.createDataFrame([(4, None, 7)], stock.schema)
    assert [r.user_id for r in access.visible_inventory(homeless, users, roles, [1, 2, 4]).collect()] == [1]
    totals = {r.user_id: (r.visible_rows, r.visible_quantity) for r in access.visible_totals(stock, users, roles).collect()}
    assert totals == {1: (3, 18), 2: (2, 11), 3: (1, 7), 4: (1, 7), 5: (0, 0)}
    asked = spark.createDataFrame([(1,), (2,), (None,)], "requested_store long")
    assert access.may_access(asked, "staff", 1).count() == 2 and access.may_access(asked, "admin", 1).count() == 3


def test_role_lookup_default(spark):
    employees = spark.createDataFrame([("a@x.y", "MANAGER"), ("n@x.y", None)], "email string, role string")
    emails = spark.createDataFrame([("a@x.y",), ("n@x.y",), ("z@x.y",)], "email string")
    assert rows(access.role_of(emails, employees)) == [("a@x.y", "MANAGER"), ("n@x.y", "STAFF"), ("z@x.y", "STAFF")]


def test_ratio_order_puts_missing_threshold_last(spark):
    stock = spark.createDataFrame([(1, 1, 1, 0, 0), (2, 1, 2, 5, 10), (3, 1, 3, 1, 10)], "id int, store_id int, product_id int, quantity int, low_stock int")
    names = spark.createDataFrame([(1, "s", "l")], "id int, name string, location string")
    products = spark.createDataFrame([(i, "p", "c", "pcs", 1) for i in (1, 2, 3)], "id int, name string, category string, unit string, price int")
    assert [r.id for r in stores.low_stock_by_ratio(stock, names, products).collect()] == [3, 2, 1]


def test_empty_store_kpi(spark):
    t = DriverTables(spark, FOLDER)
    row = stores.store_kpi(t.stores, t.store_products, t.users, t.inventory, t.ledger, dt.datetime(2030, 1, 1), store_id=12).first()
    assert (row.store_count, row.total_stock, row.low_stock_count, row.daily_sales) == (1, None, 0, 0)


def test_ledger_filters(spark):
    t = DriverTables(spark, FOLDER)
    n = t.ledger.filter("store_id = 2 AND product_id = 5 AND type = 'sale'").count()
    info = ledger.transactions_page_info(t.ledger.filter("product_id = 5"), t.stores, t.store_products, store_id=2, kind="sale", size=2).first()
    assert info.total == n and info.pages == math.ceil(n / 2)
    one = t.ledger.orderBy("id").first()
    found = ledger.transaction_by_id(t.ledger, t.stores, t.store_products, t.users, one.id).collect()
    assert [(r.id, r.change_amount) for r in found] == [(one.id, one.change_amount)]
    assert ledger.transaction_by_id(t.ledger, t.stores, t.store_products, t.users, -5).count() == 0


def test_totals_agree(spark):
    """Net is gross less discount up to rounding; the daily fact adds up to the sales."""
    sales = queries()["fact_sales"](spark, FOLDER)
    off = sales.filter(F.abs(F.col("gross_amount") - F.col("discount_amount") - F.col("net_amount")) > 0.011)
    assert off.count() == 0
    daily = queries()["fact_orders_daily"](spark, FOLDER)
    a = sales.agg(F.sum("net_amount"), F.sum("cost_amount"), F.countDistinct("order_id")).first()
    b = daily.agg(F.sum("total_net"), F.sum("total_cost"), F.sum("total_orders")).first()
    assert a[2] == b[2] and abs(a[0] - b[0]) < 0.01 and abs(a[1] - b[1]) < 0.01


def test_build_star(spark):
    t = DriverTables(spark, FOLDER)
    tables = star.build_star(t, {"dim_branch": t.dim_branch.limit(0), "dim_product": t.dim_product.limit(0)})
    assert tables["dim_branch"].count() == 25
    keys = [r.product_key for r in tables["dim_product"].select("product_key").collect()]
    assert sorted(keys) == list(range(1, t.products.count() + 1))
    assert tables["fact_sales"].count() == 6000


def test_warehouse_loads_and_partial_reload(spark, folder):
    from tillhouse.plans.warehouse import Warehouse

    store, t = Warehouse(folder), DriverTables(spark, FOLDER)
    store.load_dimensions(t, 1, dt.date(2026, 1, 1))
    store.load_facts(t, 1)
    first = rows(store.dimension(spark, "dim_product", 1))
    store.load_dimensions(t, 2, dt.date(2026, 2, 2))
    assert rows(store.dimension(spark, "dim_product", 2)) == first
    sales = store.fact(spark, "fact_sales")
    before = rows(sales.select("order_id", "product_key", "net_amount", "time_key"))
    assert len(before) == 6000

    days = (dt.date(1997, 3, 1), dt.date(1997, 3, 31))
    store.load_facts(DriverTables(spark, FOLDER, days), 2, days)
    assert rows(store.fact(spark, "fact_sales").select("order_id", "product_key", "net_amount", "time_key")) == before

    month = store.fact(spark, "fact_sales", *days)
    assert "PartitionFilters: [isnotnull(time_key" in month._jdf.queryExecution().executedPlan().toString()
    day = dt.date(1997, 3, 12)
    kept = dashboard.kpi(month, store.dimension(spark, "dim_time", 2), t.dim_branch, t.dim_product, day)
    inline = dashboard.kpi(queries_sales(t), star.dim_time(t.order_headers), t.dim_branch, t.dim_product, day)
    assert rows(kept) == rows(inline)
    daily = store.fact(spark, "fact_orders_daily").agg(F.sum("total_net"), F.sum("total_orders")).first()
    sales = store.fact(spark, "fact_sales")  # the files listed before the reload are gone
    assert daily == sales.agg(F.sum("net_amount"), F.countDistinct("order_id")).first()


def test_unknown_members_get_placeholders_that_keep_their_keys(spark, folder):
    from tillhouse.plans.warehouse import Warehouse

    store, t = Warehouse(folder), DriverTables(spark, FOLDER)
    store.load_dimensions(t, 1, dt.date(2026, 1, 1))
    known = {r.branch_id: r.branch_key for r in store.dimension(spark, "dim_branch", 1).collect()}
    events = spark.createDataFrame([(3, 1), (900, 1), (900, 7000), (None, 5), (901, None)], "branch_id int, product_id int")
    assert store.infer_members(spark, 1, events.limit(1)) == 1
    load = store.infer_members(spark, 1, events)
    assert load == 2 and store.infer_members(spark, 2, events) == 2
    branches, products = store.dimension(spark, "dim_branch", 2), store.dimension(spark, "dim_product", 2)
    placeholders = {r.branch_id: r.branch_key for r in branches.filter("name IS NULL").collect()}
    assert set(placeholders) == {900, 901} and set(placeholders.values()) == {max(known.values()) + k for k in (1, 2)}
    facts = events.dropna().join(branches, "branch_id").join(products, "product_id")
    assert facts.count() == 3 and products.filter("product_id = 7000 AND name IS NULL").count() == 1

    later = spark.createDataFrame([(900, "New Town", 1)], "id long, name string, traffic_weight int")
    more = SimpleNamespace(spark=spark, branches=t.branches.unionByName(later, allowMissingColumns=True), products=t.products, order_times=t.order_times)
    store.load_dimensions(more, 3, dt.date(2026, 3, 3))
    dim = {r.branch_id: r for r in store.dimension(spark, "dim_branch", 3).collect()}
    assert {i: dim[i].branch_key for i in known} == known
    assert (dim[900].branch_key, dim[900].name, dim[900].valid_from) == (placeholders[900], "New Town", dt.date(2026, 3, 3))
    assert (dim[901].branch_key, dim[901].name) == (placeholders[901], None)


def test_edits_in_a_batch_equal_edits_one_by_one(spark):
    rng = random.Random(4)
    users = spark.createDataFrame([(1, 1, 1, True), (2, 2, 1, True), (3, 2, 2, True), (4, 2, 2, False), (5, 2, None, True)], "id long, role_id long, store_id long, active boolean")
    roles = spark.createDataFrame([(1, "admin"), (2, "staff")], "id long, name string")
    level = {(1, 1): (5, 3), (2, 1): (0, 4), (1, 3): (7, 5)}
    stock = spark.createDataFrame([(s, p, *v) for (s, p), v in level.items()], "store_id long, product_id long, quantity long, low_stock long")
    asked = []
    for i in range(120):
        at = dt.datetime(2026, 1, 1, 8, rng.randrange(30))
        asked.append((i, rng.choice([1, 2, 3, 4, 5, 9, None]), rng.choice([1, 2, 1, 2, 0, None]), rng.choice([1, 2, 3, 0]), rng.choice([0, 4, 7, None]), rng.choice([None, 2]), at))
    rng.shuffle(asked)
    batch = spark.createDataFrame(asked, "id long, user_id long, store_id long, product_id long, quantity long, low_stock long, created_at timestamp_ntz")
    outcome, log = {}, []
    for i, user, store, product, quantity, low, at in sorted(asked, key=lambda e: (e[6], e[0])):
        if not store or not product or quantity is None:
            outcome[i] = "invalid"
        elif user != 1 and (user, store) not in ((2, 1), (3, 2)):
            outcome[i] = "refused"
        else:
            outcome[i] = "accepted"
            change = quantity - level.get((store, product), (0,))[0]
            if change:
                log.append((i, store, product, change, "import" if change > 0 else "sale", user, at))
            level[store, product] = (quantity, 10 if low is None else low)
    checked = edits.checked(batch, users, roles)
    assert {r.id: r.outcome for r in checked.collect()} == outcome and set(outcome.values()) == {"invalid", "refused", "accepted"}
    assert rows(edits.ledger_of_edits(stock, checked)) == sorted(log, key=str)
    assert rows(edits.stock_after_edits(stock, checked)) == sorted(((*k, *v) for k, v in level.items()), key=str)


class _Shop:
    """Orders and items of a small shop, as lists that a test may change."""

    def __init__(self, spark):
        self.spark, self.headers, self.lines = spark, {}, {}

    @property
    def orders(self):
        data = [(i, b, Decimal(sum(q * p for _, q, p in self.lines.get(i, []))), Decimal(d), at) for i, (b, d, at) in self.headers.items()]
        return self.spark.createDataFrame(data, "id long, branch_id long, gross_amount decimal(12,2), discount_amount decimal(12,2), created_at timestamp_ntz")

    @property
    def costed_items(self):
        data = [(i, pr, q, Decimal(p), Decimal(1)) for i in self.headers for pr, q, p in self.lines.get(i, [])]
        return self.spark.createDataFrame(data, "order_id long, product_id long, quantity int, unit_price decimal(10,2), cost_price decimal(10,2)")

    @property
    def inventory_logs(self):
        return self.spark.createDataFrame([], "branch_id long, product_id long, id long, change_amount long, new_stock_level long, reason string, created_at timestamp_ntz")

    def put(self, rng, i):
        """An order, new or in place of another; some of nothing but free items."""
        self.headers[i] = (rng.randint(1, 3), rng.choice([0, 1]), dt.datetime(2026, 1, rng.randint(1, 4), rng.randrange(24)))
        free = rng.random() < 0.3
        self.lines[i] = [(rng.randint(1, 4), rng.randint(1, 5), 0 if free else rng.randint(2, 9)) for _ in range(rng.randint(0, 3))]


def test_changes_of_orders_equal_a_full_reload(spark, folder):
    rng, shop = random.Random(8), _Shop(spark)
    from tillhouse.plans.warehouse import Warehouse

    def warehouse(name):
        store = Warehouse(f"{folder}/{name}")
        for dim, data in (("dim_branch", "id branch_id, name"), ("dim_product", "id product_id, name, 'c' AS category")):
            key = dim.replace("dim", "").strip("_") + "_key"
            rows_ = spark.range(1, 5).selectExpr("id", "concat('n', id) AS name").selectExpr(f"id + 10 AS {key}", *data.split(", "), "DATE'2026-01-01' AS valid_from", "true AS is_current")
            rows_.write.parquet(store.path(dim) + "/load=1")
        return store

    for i in range(12):
        shop.put(rng, i)
    kept = warehouse("kept")
    kept.load_facts(shop, 1)
    for step in range(4):
        touched = rng.sample(range(12 + 3 * step), 5)
        for i in touched:
            if rng.random() < 0.4:
                shop.headers.pop(i, None)
            else:
                shop.put(rng, i)
        for i in range(12 + 3 * step, 15 + 3 * step):
            shop.put(rng, i)
            touched.append(i)
        if step == 2:  # a day without orders
            for i in [i for i, h in shop.headers.items() if h[2].day == 2]:
                del shop.headers[i]
                touched.append(i)
        days = None if step % 2 else (dt.date(2026, 1, 1), dt.date(2026, 1, 4))
        kept.apply_order_changes(shop, 1, spark.createDataFrame([(i,) for i in touched], "order_id long"), days)
        full = warehouse(f"full{step}")
        full.load_facts(shop, 1)
        for name in ("fact_sales", "fact_orders_daily"):
            assert rows(kept.fact(spark, name)) == rows(full.fact(spark, name)), (step, name)
            assert sorted(p.name for p in Path(kept.path(name)).glob("time_key=*")) == sorted(
                p.name for p in Path(full.path(name)).glob("time_key=*")
            )
    assert any(r.total_net is None for r in kept.fact(spark, "fact_orders_daily").collect())
    assert not list(Path(kept.folder).glob("_changes*"))


def queries_sales(t):
    return star.fact_sales(t.costed_items, t.orders, None, t.dim_branch, t.dim_product)


def test_hot_order_and_product_are_split(spark):
    """A third of the items in one order, a third on one product: the joins split both."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    t = DriverTables(spark, FOLDER)
    lines = t.raw("lineitem").withColumn("_i", F.monotonically_increasing_id() % 3)
    hot = lines.withColumns(
        {
            "l_orderkey": F.when(F.col("_i") == 0, 77).otherwise(F.col("l_orderkey")),
            "l_partkey": F.when(F.col("_i") == 1, 5).otherwise(F.col("l_partkey")),
        }
    ).drop("_i")
    t._raw["lineitem"] = hot.unionByName(hot).unionByName(hot).repartition(8)
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        sales = queries_sales(t)
        found = sales.agg(F.count(F.lit(1)), F.sum("net_amount"), F.sum("discount_amount"))
        row = found.collect()[0]
        plan = found._jdf.queryExecution().executedPlan().toString()
        totals = ledger.order_totals(t.order_items).agg(F.sum(F.col("gross_amount") - F.col("discount_amount")), F.sum("discount_amount")).first()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert plan.count("skew=true") >= 2
    assert row[0] == 18_000
    assert abs(row[1] - totals[0]) < 100 and abs(row[2] - totals[1]) < 100
