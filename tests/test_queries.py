"""Every named query against its SQL twin, on whole tables."""

import pytest

import __spark_entry__ as entry
import oracle
from compare import difference, duck, is_ordered
from tillhouse import registry

FOLDER = "/root/testdata/sf0.001"
SQL = oracle.statements()


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query_equals_sql(spark, con, name):
    assert difference(con, registry.queries()[name](spark, FOLDER), SQL[name]) is None


@pytest.mark.parametrize("name", [n for n in SQL if is_ordered(SQL[n])])
def test_order_does_not_hang_on_broadcasts(spark, con, name):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert difference(con, registry.queries()[name](spark, FOLDER), SQL[name]) is None
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_every_query_has_sql():
    assert set(SQL) == set(registry.queries())


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["feature_date", "branch_id", "product_id"]
    assert not df.isEmpty()
