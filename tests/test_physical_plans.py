"""What the plans of the named queries may and may not contain."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tillhouse.functions import explode_json_array, half_years, unreadable
from tillhouse.plans import star
from tillhouse.plans.order_store import OrderStore
from tillhouse.plans.warehouse import Warehouse
from tillhouse.registry import queries
from tillhouse.sources import DriverTables

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(queries()))
def test_no_pairs_and_no_python(spark, name):
    text = plan(queries()[name](spark, FOLDER))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "Arrow"):
        assert node not in text


def test_day_range_reaches_the_scan(spark):
    text = plan(queries()["kpi"](spark, FOLDER))
    assert "GreaterThanOrEqual(o_orderdate,2001-07-30" in text
    assert "LessThan(o_orderdate,2001-08-01" in text


def test_only_needed_columns_are_read(spark):
    text = plan(queries()["inventory_value"](spark, FOLDER))
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_quantity:double>" in text
    assert "ReadSchema: struct<p_partkey:bigint,p_retailprice:double>" in text


@pytest.mark.parametrize(
    "name,event_scans",
    [
        ("ml_features", 1),
        ("top_products_branch", 1),
        ("branch_performance", 1),
        ("ledger_balance", 2),  # one of them for the sample that hot keys are cut by
    ],
)
def test_an_input_used_twice_is_shuffled_once(spark, name, event_scans):
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # reuse shows in the plan before it runs
    try:
        df = queries()[name](spark, FOLDER)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        text = plan(df.select("*"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "ReusedExchange" in text
    assert text.count("FileScan parquet [event_id") <= event_scans and text.count("FileScan parquet [l_orderkey") <= 2


def scans(spark, name):
    """How often each table is read, by its first letters, with sort-merge joins only."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in settings}
    try:
        df = queries()[name](spark, FOLDER)
        for k, v in settings.items():
            spark.conf.set(k, v)
        text = plan(df.select("*"))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    return {t: text.count(f"FileScan parquet [{t}_") for t in "lpocn"}


@pytest.mark.parametrize(
    "name,most",
    [
        ("fact_sales", {"l": 1, "p": 2, "o": 1}),
        ("dim_product_upsert", {"p": 3}),
        ("revenue_distribution", {"l": 1, "o": 1}),
        ("stock_update_to_ledger", {"l": 1}),
        ("daily_revenue", {"l": 1, "o": 1}),
    ],
)
def test_tables_are_read_once(spark, name, most):
    found = scans(spark, name)
    assert all(found[t] <= n for t, n in most.items()), found


def test_top_k_is_cut_in_every_task(spark):
    assert "TakeOrderedAndProject" in plan(queries()["transactions_page"](spark, FOLDER))
    assert "TakeOrderedAndProject" in plan(queries()["low_stock_preview"](spark, FOLDER))
    assert "WindowGroupLimit" in plan(queries()["weighted_sample"](spark, FOLDER))


def test_json_arrays(spark):
    data = [(1, '[{"n":"7","x":1},{"n":8}]'), (2, "[oops"), (3, None), (4, "[]")]
    df = spark.createDataFrame(data, "id int, payload string")
    found = explode_json_array(df, "payload", {"n": "int", "x": "string"}, position="at").orderBy("at")
    assert [tuple(r) for r in found.collect()] == [(1, 0, 7, "1"), (1, 1, 8, None)]
    assert [r.id for r in unreadable(df, "payload").select(F.col("id")).collect()] == [2]


def files_read(df) -> dict[str, int]:
    """Files that the scans of a query read, by table folder, after it has run."""
    df.collect()
    found, todo = {}, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif "QueryStage" in name:
            todo.append(node.plan())
        elif name.startswith("Scan parquet"):
            folder = re.search(r"InMemoryFileIndex\(\d+ paths\)\[file:([^,\]]*)", node.verboseStringWithOperatorId() + node.toString())
            metric = node.metrics().get("numFiles")
            if metric.isDefined():
                key = folder[1] if folder else name
                found[key] = found.get(key, 0) + metric.get().value()
        for k in range(node.children().size()):
            todo.append(node.children().apply(k))
    return found


@pytest.fixture(scope="module")
def order_store(spark, tmp_path_factory):
    store = OrderStore(str(tmp_path_factory.mktemp("orders")), "plan_test", buckets=4)
    t = DriverTables(spark, FOLDER)
    store.open(spark)
    store.write(t.orders, t.costed_items)
    return store, t


def test_items_and_orders_join_where_they_lie(spark, order_store, tmp_path):
    """The fact load from stored tables has no exchange but the broadcasts of dimensions."""
    store, t = order_store
    t.dim_branch.write.parquet(f"{tmp_path}/branches")
    t.dim_product.write.parquet(f"{tmp_path}/products")
    dims = [spark.read.parquet(f"{tmp_path}/{n}") for n in ("branches", "products")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "12KB")  # the dimensions, not the orders
    try:
        sales = star.fact_sales(store.items(spark), store.orders(spark), None, *dims)
        text = plan(sales.select("*"))
        assert "SortMergeJoin" in text and "BroadcastHashJoin" in text
        assert "Exchange hashpartitioning" not in text and "Exchange rangepartitioning" not in text
        one_order_a_row = store.items(spark).groupBy("order_id").agg(F.sum("quantity"))
        assert "Exchange" not in plan(one_order_a_row)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    expected = star.fact_sales(t.costed_items, t.orders, None, t.dim_branch, t.dim_product)
    assert sorted(map(str, sales.collect())) == sorted(map(str, expected.select(*sales.columns).collect()))


def test_a_range_of_days_reads_its_half_years(spark, order_store):
    store, t = order_store
    first, last = dt.date(1997, 5, 20), dt.date(1997, 8, 2)
    day = F.to_date("created_at")
    for read, bound in ((store.orders(spark, first, last), day.between(first, last)), (store.orders(spark, last), day >= last)):
        assert read.count() == t.order_headers.filter(bound).count() > 0
    everything = sum(files_read(store.orders(spark).select("id")).values())
    assert sum(files_read(store.orders(spark, first, last).select("id")).values()) == 2 * 4 < everything / 4
    assert "PartitionFilters: [isnotnull(year" in plan(store.items(spark, first, last))
    for a, b in ((None, last), (first, None), (None, None)):
        own = half_years(a, b)
        assert (own is None) == (a is None and b is None)


def test_a_half_year_is_replaced_and_found_again(spark, order_store, tmp_path):
    _, t = order_store
    store = OrderStore(str(tmp_path), "replaced", buckets=2)
    store.open(spark)
    store.write(t.orders, t.costed_items)
    days = (dt.date(1998, 1, 1), dt.date(1998, 6, 30))
    some = DriverTables(spark, FOLDER, days)
    cheaper = some.orders.withColumn("discount_amount", F.lit(0).cast("decimal(12,2)"))
    store.write(cheaper, some.costed_items)
    again = OrderStore(str(tmp_path), "found_again", buckets=2)
    again.open(spark)
    assert again.orders(spark).count() == t.orders.count() and again.items(spark).count() == t.costed_items.count()
    assert again.orders(spark, *days).filter("discount_amount <> 0").count() == 0
    assert again.orders(spark).filter("discount_amount <> 0").count() > 0


def test_a_filter_on_days_prunes_the_stored_fact(spark, tmp_path):
    """Only the days of the filtered dimension are read, by dynamic partition pruning."""
    store, days = Warehouse(str(tmp_path)), (dt.date(1997, 3, 1), dt.date(1997, 5, 31))
    t = DriverTables(spark, FOLDER, days)
    store.load_dimensions(t, 1, dt.date(2026, 1, 1))
    store.load_facts(t, 1)
    march = store.dimension(spark, "dim_time", 1).filter("month = 3 AND is_weekend")
    sales = store.fact(spark, "fact_sales").join(march, "time_key").groupBy("day_name").agg(F.sum("net_amount"))
    assert "dynamicpruning" in plan(sales)
    read = sum(n for f, n in files_read(sales).items() if "fact_sales" in f)
    in_all = len({f for f in store.fact(spark, "fact_sales").inputFiles()})
    weekends = march.count()
    assert 0 < read <= 2 * weekends < in_all / 3
