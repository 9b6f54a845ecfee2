"""The order, stock and event tables of ``TESTDATA.md`` seen as retail tables.

Each property is a lazy DataFrame over whole parquet tables; nothing is cached
or collected. Ids, levels and dirty values that the source tables lack are
derived from their columns by fixed rules.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import all_of, as_money, from_cents, rounded_quotient, to_cents
from ..operators import combinations
from ..operators.folds import clamped_balance, level_changes
from ..plans import ledger as ledger_plans
from ..plans import pos as pos_plans

STORES = 10  # stores that keep stock; the others exist without any
LEDGER_PRODUCTS = 45
ROLES = 10  # roles that users hold
START_LEVEL = 10_000
SHELF_LEVEL = 120  # start level of the branch stock, low enough for some to go negative


# Declared, so that opening a table reads no file footer.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "pages": "page_id long, url string, html string",
}


def _given_cost(key: Column, price: Column) -> Column:
    """What a product costs, unknown for some and zero for others."""
    cost = F.when(key % 10 == 1, F.lit(0)).otherwise(price * F.lit(Decimal("0.35")))
    return F.when(key % 10 != 0, cost).cast("decimal(10,2)")


class DriverTables:
    """``order_days`` limits orders, and with them their items, to a day range, open
    at the end if the second day is None.
    The filter is on the stored date column, so it reaches the parquet scan."""

    def __init__(self, spark: SparkSession, folder: str, order_days: tuple[dt.date, dt.date | None] | None = None):
        self.spark = spark
        self.folder = folder
        self.order_days = order_days
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")
        return self._raw[name]

    # ---- order side -------------------------------------------------------

    @cached_property
    def _raw_orders(self) -> DataFrame:
        orders = self.raw("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        if self.order_days is None:
            return orders
        first, last = self.order_days
        day = F.col("o_orderdate")
        until = None if last is None else day < F.lit(last + dt.timedelta(days=1))
        return orders.filter(all_of([day >= F.lit(first), until]))

    @cached_property
    def branches(self) -> DataFrame:
        return self.raw("nation").select(
            F.col("n_nationkey").alias("id"),
            F.col("n_name").alias("name"),
            (F.col("n_nationkey") % 7 + 1).alias("traffic_weight"),
        )

    @cached_property
    def products(self) -> DataFrame:
        key = F.col("p_partkey")
        price = F.col("p_retailprice").cast("decimal(10,2)")
        return self.raw("part").select(
            key.alias("id"),
            F.concat("p_name", F.lit(" #"), key.cast("string")).alias("name"),
            F.col("p_type").alias("category"),
            price.alias("base_price"),
            F.col("p_size").alias("popularity_weight"),
            _given_cost(key, price).alias("cost_price"),
        )

    @cached_property
    def costed_items(self) -> DataFrame:
        """Order items with price and cost, both from one look at the products."""
        lines = self.raw("lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_discount")
        if self.order_days is not None:
            wanted = self._raw_orders.select(F.col("o_orderkey").alias("l_orderkey"))
            lines = lines.join(wanted, "l_orderkey", "left_semi")
        prices = self.raw("part").select("p_partkey", "p_retailprice")
        quantity = F.col("l_quantity").cast("int")
        percent = F.floor(F.col("l_discount") * 100 + 0.5)
        # Price in cents times whole percents, back to cents.
        discount = from_cents(rounded_quotient(to_cents(F.col("unit_price")) * quantity * percent, F.lit(100)))
        priced = lines.join(prices, F.col("l_partkey") == F.col("p_partkey"))
        priced = priced.withColumn("base_price", F.col("p_retailprice").cast("decimal(10,2)"))
        priced = priced.withColumn("cost_price", _given_cost(F.col("p_partkey"), F.col("base_price")))
        return ledger_plans.cost_price_default(priced).withColumn("unit_price", F.col("base_price")).select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            quantity.alias("quantity"),
            "unit_price",
            discount.alias("discount"),
            "cost_price",
        )

    @cached_property
    def order_items(self) -> DataFrame:
        return self.costed_items.drop("cost_price")

    @cached_property
    def orders(self) -> DataFrame:
        """Order headers with the totals of their items; 0 for an empty order."""
        totals = ledger_plans.order_totals(self.order_items)
        zero = F.lit(Decimal("0.00"))
        return self.order_headers.join(totals, F.col("id") == F.col("order_id"), "left").select(
            "id",
            "branch_id",
            "created_at",
            as_money(F.coalesce("gross_amount", zero)).alias("gross_amount"),
            as_money(F.coalesce("discount_amount", zero)).alias("discount_amount"),
        )

    @cached_property
    def order_times(self) -> DataFrame:
        """Ids and times of the orders, for which no branch has to be looked up."""
        hours = F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % 24).cast("int"))
        return self._raw_orders.select(
            F.col("o_orderkey").alias("id"), "o_custkey", (F.col("o_orderdate") + hours).alias("created_at")
        )

    @cached_property
    def order_headers(self) -> DataFrame:
        customers = self.raw("customer").select("c_custkey", F.col("c_nationkey").alias("branch_id"))
        return self.order_times.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
            "id", "branch_id", "created_at"
        )

    @cached_property
    def dim_branch(self) -> DataFrame:
        """The stored branch dimension, keyed by an earlier load in id order."""
        return self.branches.select((F.col("id") + 1).cast("long").alias("branch_key"), F.col("id").alias("branch_id"), "name")

    @cached_property
    def dim_product(self) -> DataFrame:
        """The stored product dimension, keyed by an earlier load in id order."""
        return self.products.select((F.col("id") + 1).alias("product_key"), F.col("id").alias("product_id"), "name", "category")

    @cached_property
    def stock_matrix(self) -> DataFrame:
        pairs = combinations(
            self.branches.select(F.col("id").alias("branch_id")),
            self.products.select(F.col("id").alias("product_id")),
        )
        return pairs.withColumn("stock_level", F.lit(START_LEVEL))

    @cached_property
    def consumption(self) -> DataFrame:
        """Units sold per (branch, product)."""
        branch_of = self.order_headers.select(F.col("id").alias("order_id"), "branch_id")
        return (
            self.order_items.select("order_id", "product_id", "quantity")
            .join(branch_of, "order_id")
            .groupBy("branch_id", "product_id")
            .agg(F.sum("quantity").alias("total_qty"))
        )

    @cached_property
    def inventory_current(self) -> DataFrame:
        """Shelf stock of every (branch, product) that sold anything."""
        level = (F.lit(SHELF_LEVEL) - F.col("total_qty")).cast("long")
        return self.consumption.select("branch_id", "product_id", level.alias("stock_level"))

    # ---- event side -------------------------------------------------------

    @cached_property
    def _events(self) -> DataFrame:
        key = F.get_json_object("props", "$.k").cast("int")
        return self.raw("events").withColumn("k", key)

    @cached_property
    def pos_events(self) -> DataFrame:
        """Raw sales events; every tenth arrives twice, error events have no price."""
        copies = F.when(F.col("event_id") % 10 == 0, 2).otherwise(1)
        return (
            self._events.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
            .select(
                F.concat(F.lit("txn_"), F.col("event_id").cast("string")).alias("transaction_id"),
                (F.col("user_id") % 10 + 1).cast("int").alias("branch_id"),
                (F.col("k") % 20 + 1).alias("product_id"),
                (F.col("k") % 5 + 1).alias("quantity"),
                F.when(F.col("event_type") == "error", 0.0).otherwise(F.col("value")).alias("unit_price"),
                F.col("ts").cast("string").alias("timestamp"),
            )
        )

    @cached_property
    def staged(self) -> DataFrame:
        return pos_plans.stage(self.pos_events)

    @cached_property
    def ledger(self) -> DataFrame:
        kind = (
            F.when(F.col("event_type") == "signup", "import")
            .when(F.col("event_type") == "error", "adjustment")
            .otherwise("sale")
        )
        k = F.col("k")
        amount = F.when(kind == "import", k % 26 + 5).when(kind == "adjustment", k % 16 - 5).otherwise(-(k % 10 + 1))
        return self._events.select(
            F.col("event_id").alias("id"),
            (F.col("user_id") % STORES + 1).alias("store_id"),
            (k % LEDGER_PRODUCTS + 1).cast("long").alias("product_id"),
            amount.cast("long").alias("change_amount"),
            kind.alias("type"),
            F.col("user_id").alias("created_by"),
            F.col("ts").alias("created_at"),
        )

    @cached_property
    def inventory_logs(self) -> DataFrame:
        """Stock movements of the ledger, as the change log would record them."""
        key, order = ["store_id", "product_id"], ["created_at", "id"]
        levels = clamped_balance(self.ledger, key, "change_amount", order, self.inventory, before="before")
        changes = level_changes(levels, key, "quantity", order, before="before")
        return changes.withColumnRenamed("store_id", "branch_id")

    @cached_property
    def audit_logs(self) -> DataFrame:
        """Audit rows; k = 0 stands for the system, and some users no longer exist."""
        k = F.col("k")
        action = (
            F.when(F.col("event_type") == "signup", "CREATE")
            .when(F.col("event_type") == "error", "DELETE")
            .when(F.col("event_type") == "purchase", "UPDATE")
            .otherwise(F.upper("event_type"))
        )
        return self._events.select(
            F.col("event_id").alias("id"),
            F.when(k != 0, F.col("user_id") * 11).alias("user_id"),
            action.alias("action"),
            F.when(k % 2 == 0, "inventory").otherwise("users").alias("table_name"),
            k.cast("long").alias("record_id"),
            F.col("props").alias("new_value"),
            F.col("ts").alias("created_at"),
        )

    # ---- stores -----------------------------------------------------------

    @cached_property
    def stores(self) -> DataFrame:
        return self.raw("nation").select(
            (F.col("n_nationkey") + 1).cast("long").alias("id"),
            F.col("n_name").alias("name"),
            F.concat(F.lit("Region "), F.col("n_regionkey").cast("string")).alias("location"),
        )

    @cached_property
    def store_products(self) -> DataFrame:
        return self.products.select("id", "name", "category", F.col("base_price").alias("price"), F.lit("pcs").alias("unit"))

    @cached_property
    def inventory(self) -> DataFrame:
        """Stock per (store, product): what suppliers delivered, cut to shelf size."""
        product = F.col("l_partkey")
        return (
            self.raw("lineitem")
            .groupBy((F.col("l_suppkey") % STORES + 1).alias("store_id"), product.alias("product_id"))
            .agg((F.sum(F.col("l_quantity").cast("long")) % 100).alias("quantity"))
            .select(
                (F.col("product_id") * STORES + F.col("store_id") - 1).alias("id"),
                "store_id",
                "product_id",
                "quantity",
                (F.col("product_id") % 4 * 10).alias("low_stock"),
            )
        )

    @cached_property
    def lots(self) -> DataFrame:
        products = self.products.select(F.col("id").alias("product_id"), F.col("name").alias("product_name"), F.col("category").alias("ingredient_type"))
        lines = self.raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
        expiry = F.date_add(F.to_date("l_shipdate"), 30)
        number = F.concat(
            F.lit("LOT-"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")
        )
        return lines.join(products, F.col("l_partkey") == F.col("product_id")).select(
            (F.col("l_suppkey") % 10 + 1).alias("branch_id"),
            "product_name",
            "ingredient_type",
            F.col("l_quantity").cast("decimal(10,2)").alias("stock_quantity"),
            F.lit("kg").alias("unit"),
            F.lit(Decimal("10.00")).cast("decimal(10,2)").alias("reorder_level"),
            F.when(F.col("l_linenumber") != 7, expiry).alias("expiry_date"),
            number.alias("batch_number"),
        )

    # ---- people -----------------------------------------------------------

    @cached_property
    def users(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.raw("customer").select(
            key.alias("id"),
            F.col("c_name").alias("name"),
            F.concat(F.lower(F.translate("c_name", "#", ".")), F.lit("@example.com")).alias("email"),
            (key % ROLES).alias("role_id"),
            (F.floor(key / ROLES) % STORES + 1).alias("store_id"),
            (F.col("c_acctbal") >= 0).alias("active"),
        )

    @cached_property
    def user_changes(self) -> DataFrame:
        """Patches: accounts in debt are re-activated, some with a new role or mail."""
        key = F.col("c_custkey")
        mail = F.concat(F.lit("user"), key.cast("string"), F.lit("@example.org"))
        return self.raw("customer").filter(F.col("c_acctbal") < 0).select(
            key.alias("id"),
            F.lit(None).cast("string").alias("name"),
            F.when(key % 2 == 0, mail).alias("email"),
            F.when(key % 3 == 0, F.lit(1).cast("long")).alias("role_id"),
            F.lit(True).alias("active"),
        )

    @cached_property
    def roles(self) -> DataFrame:
        """One role per supplier; number 0 is the administrator."""
        key = F.col("s_suppkey")
        return self.raw("supplier").select(
            key.alias("id"),
            F.when(key == 0, "admin").otherwise(F.col("s_name")).alias("name"),
            F.concat(F.lit("Nation "), F.col("s_nationkey").cast("string")).alias("description"),
        )

    @cached_property
    def permissions(self) -> DataFrame:
        """One permission per brand, numbered by the brand's number."""
        brand = F.col("p_brand")
        number = F.substring_index(brand, "#", -1).cast("long")
        return self.raw("part").select(brand).distinct().select(
            number.alias("id"),
            F.concat(F.lit("manage_"), F.lower(brand)).alias("key"),
            F.concat(F.lit("Manage "), brand).alias("label"),
        )

    @cached_property
    def role_permissions(self) -> DataFrame:
        """A supplier may manage the brands it delivered."""
        boxes = self.raw("lineitem").select("l_suppkey", "l_partkey")
        brands = self.raw("part").select(
            "p_partkey", F.substring_index("p_brand", "#", -1).cast("long").alias("permission_id")
        )
        return (
            boxes.join(brands, F.col("l_partkey") == F.col("p_partkey"))
            .select(F.col("l_suppkey").alias("role_id"), "permission_id")
            .distinct()
        )

    @cached_property
    def sign_ups(self) -> DataFrame:
        """User forms as typed in, a good part of them faulty."""
        key = F.col("c_custkey")
        text = key.cast("string")
        name = F.when(key % 11 == 0, F.lit(" x ")).when(key % 17 == 0, F.lit(None)).otherwise(F.col("c_name"))
        mail = F.lower(F.col("c_mktsegment"))
        email = (
            F.when(key % 7 == 0, F.concat(mail, F.lit("@example")))
            .when(key % 13 == 0, F.concat(mail, F.lit("@@example.com")))
            .when(key % 19 == 0, F.concat(mail, F.lit(" "), text, F.lit("@example.com")))
            .otherwise(F.concat(mail, text, F.lit("@example.com")))
        )
        role = (
            F.when(key % 5 == 0, F.lit(""))
            .when(key % 9 == 0, F.lit("1.5"))
            .when(key % 8 == 0, F.lit("2.0"))
            .otherwise((key % 10).cast("string"))
        )
        return self.raw("customer").select(
            key.alias("id"),
            name.alias("name"),
            email.alias("email"),
            F.repeat(text, 3).alias("password"),
            role.alias("role_id"),
        )

    @cached_property
    def stock_forms(self) -> DataFrame:
        """Stock levels as typed in per delivery, some of them faulty."""
        q = F.col("l_quantity").cast("int")
        amount = (
            F.when(q % 10 == 0, (-q).cast("string"))
            .when(q % 10 == 1, F.concat(q.cast("string"), F.lit(".5")))
            .otherwise(q.cast("string"))
        )
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("form_id"),
            (F.col("l_suppkey") % (STORES + 1)).cast("string").alias("store_id"),
            F.col("l_partkey").cast("string").alias("product_id"),
            amount.alias("quantity"),
            F.when(F.col("l_linenumber") > 3, F.when(F.col("l_linenumber") == 7, "many").otherwise("10")).alias("low_stock"),
        )

    @cached_property
    def raw_profiles(self) -> DataFrame:
        """Sign-ups of an identity provider: an id, an address and loose JSON."""
        key = F.col("c_custkey")
        text = key.cast("string")
        fields = F.concat_ws(
            ",",
            F.when(key % 3 != 0, F.concat(F.lit('"employee_code":"E'), text, F.lit('"'))),
            F.when(key % 4 != 0, F.concat(F.lit('"name":"'), F.col("c_name"), F.lit('"'))),
            F.when(key % 5 == 0, F.lit('"role":"MANAGER"')),
            F.when(key % 7 != 0, F.concat(F.lit('"branch_id":"'), F.col("c_nationkey").cast("string"), F.lit('"'))),
        )
        return self.raw("customer").select(
            F.md5(text).alias("id"),
            F.concat(F.lit("user"), text, F.lit("@example.com")).alias("email"),
            F.concat(F.lit("{"), fields, F.lit("}")).alias("raw_user_meta_data"),
        )

    @cached_property
    def product_payloads(self) -> DataFrame:
        """Catalogue uploads: per part a JSON array with the product and one more
        entry of the same type, whose name other uploads repeat."""
        key = F.col("p_partkey").cast("string")
        price = F.col("p_retailprice").cast("decimal(10,2)").cast("string")
        size = F.col("p_size").cast("string")

        def entry(name):
            return F.concat(
                F.lit('{"name":"'), name, F.lit('","category":"'), F.col("p_type"), F.lit('","base_price":"'), price,
                F.lit('","popularity_weight":'), size, F.lit("}"),
            )

        named = entry(F.concat(F.col("p_name"), F.lit(" #"), key))
        shared = entry(F.concat(F.col("p_name"), F.lit(" "), F.col("p_type")))
        return self.raw("part").select(
            F.col("p_partkey").alias("upload_id"),
            F.concat(F.lit("["), named, F.lit(","), shared, F.lit("]")).alias("payload"),
        )
