"""Operators against plain Python on small and random data."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillhouse.functions import as_money, is_email, is_whole_number, js_trim, percent_change, pg_asc, pg_desc, share_cents
from tillhouse.functions.text import JS_SPACE
from tillhouse.operators import (
    accepted,
    clamped_balance,
    combinations,
    delete_cascade,
    delete_set_null,
    duplicate_keys,
    insert_absent,
    level_changes,
    missing_fields,
    number_rows,
    numbered,
    orphans,
    page,
    page_after,
    page_info,
    patch,
    rank_descending,
    rejected,
    replace_children,
    sanitize,
    snapshot_diff,
    stock_changes,
    update_from,
    update_where,
    upsert,
    validate,
    weighted_sample,
    with_previous,
)
from tillhouse.operators import keys as key_module
from tillhouse.operators import ranking
from tillhouse.operators.keys import assign_surrogate_keys
from tillhouse.operators.pieces import with_pieces
from tillhouse.operators.rules import inventory_rules, ledger_rules, user_rules
from tillhouse.schemas import LEDGER_TYPES


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# ---- ranks and keys -----------------------------------------------------------


@pytest.mark.parametrize("seed", [1, 2])
def test_rank_equals_window_rank(spark, seed):
    rng = random.Random(seed)
    values = [None, 0, 0.5, -3, 7, 7, 1e9, 1e9 + 1, *[rng.randint(-50, 50) for _ in range(300)]]
    data = [(rng.choice(["a", "b", None]), float(v) if v is not None else None, i) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, "g string, v double, id int")
    df.createOrReplaceTempView("ranked_input")
    by_group = spark.sql(
        "SELECT g, v, id, rank() OVER (PARTITION BY g ORDER BY v DESC NULLS FIRST) AS rank FROM ranked_input"
    )
    assert rows(rank_descending(df, "v", by=["g"])) == rows(by_group)
    assert rows(rank_descending(df, "v", by=["g"], values=10)) == rows(by_group)
    overall = spark.sql("SELECT g, v, id, rank() OVER (ORDER BY v DESC NULLS FIRST) AS rank FROM ranked_input")
    assert rows(rank_descending(df, "v")) == rows(overall)
    assert rows(rank_descending(df, "v", values=10)) == rows(overall)


def test_a_group_of_close_values_is_ranked_in_pieces(spark):
    """All values within a thousandth of each other; pieces are about equal, ranks right."""
    df = spark.range(20_000).selectExpr("'g' AS g", "1000000 + (id * 7919 % 20000) / 20000 AS v")
    counts = df.groupBy("g", F.col("v").alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
    sizes = [r["count"] for r in ranking._with_piece(counts, ["g"], 1000).groupBy("_piece").count().collect()]
    assert len(sizes) > 50 and max(sizes) < 3 * 20_000 / 64
    ranked = rank_descending(df, "v", by=["g"], values=1000)
    assert ranked.filter("rank <> 1 + round((1000001 - v) * 20000 - 1)").count() == 0


def test_number_rows_of_any_keys(spark):
    rng = random.Random(3)
    sparse = [rng.randrange(1 << 62) for _ in range(60)]
    for keys, kind in ((rng.sample(range(500), 120), "long"), (sparse, "long"), ([f"k{i}" for i in range(50)], "string")):
        df = spark.createDataFrame([(k,) for k in keys], f"id {kind}")
        found = {r.id: r.n for r in number_rows(df, "id", "n").collect()}
        assert sorted(found.values()) == list(range(1, len(keys) + 1)) and set(found) == set(keys)
        again = {r.id: r.n for r in number_rows(df.repartition(5), "id", "n").collect()}
        assert again == found


def test_a_row_without_key_is_an_error_not_a_loss(spark):
    df = spark.createDataFrame([(None,), (5,)], "id long")
    with pytest.raises(Exception, match="has no id"):
        number_rows(df, "id", "n").collect()


def test_numbering_blocks_are_few(spark):
    """Also for ids far apart the table of blocks stays within its bound."""
    df = spark.range(300).selectExpr("id << 40 AS id")
    blocks = df.select(key_module._block("id").alias("b")).distinct().count()
    assert blocks <= 16**key_module.BLOCK_DIGITS


def test_surrogate_keys_continue_and_repeat(spark):
    dim = spark.createDataFrame([(7, 1), (9, 2)], "k long, id long")
    new = spark.createDataFrame([(30,), (10,)], "id long")
    numbered = rows(assign_surrogate_keys(dim, new, "id", "k").select("id", "k"))
    assert sorted(k for _, k in numbered) == [10, 11] and [i for i, _ in numbered] == [10, 30]
    assert rows(assign_surrogate_keys(dim, new, "id", "k").select("id", "k")) == numbered
    empty = dim.limit(0)
    assert sorted(k for _, k in rows(assign_surrogate_keys(empty, new, "id", "k").select("id", "k"))) == [1, 2]


# ---- folds ----------------------------------------------------------------------


def _fold(events, opening):
    level, out = dict(opening), {}
    for key, _, id_, change in sorted(events, key=lambda e: (e[1], e[2])):
        level[key] = max(0, level.get(key, 0) + change)
        out[id_] = level[key]
    return out


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 2), st.integers(0, 40), st.integers(-9, 6)), min_size=1, max_size=60))
def test_clamped_balance_equals_sequential_fold(spark, data):
    events = [(k, minutes * 17, i, c) for i, (k, minutes, c) in enumerate(data)]
    df = spark.createDataFrame(events, "k long, minute int, id long, change long").withColumn(
        "at", F.timestamp_seconds(F.col("minute") * 60)
    )
    opening = spark.createDataFrame([(1, 5)], "k long, quantity long")
    for size in (1 << 20, 4):
        found = clamped_balance(df, ["k"], "change", ["at", "id"], opening, rows=size)
        assert {r.id: r.quantity for r in found.collect()} == _fold(events, {1: 5})


def test_events_without_key_are_a_key_of_their_own(spark):
    data = [(None, 0, 1, 5), (None, 90, 2, -7), (1, 5, 3, 4)]
    df = spark.createDataFrame(data, "k long, minute int, id long, change long")
    df = df.withColumn("at", F.timestamp_seconds(F.col("minute") * 60))
    for size in (1 << 20, 1):
        found = clamped_balance(df, ["k"], "change", ["at", "id"], before="was", rows=size).collect()
        assert {r.id: (r.quantity, r.was) for r in found} == {1: (5, None), 2: (0, 5), 3: (4, None)}


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 2), st.integers(0, 40), st.integers(-9, 6)), min_size=1, max_size=40))
def test_level_before_equals_the_lag(spark, data):
    events = [(k, minutes * 17, i, c) for i, (k, minutes, c) in enumerate(data)]
    df = spark.createDataFrame(events, "k long, minute int, id long, change long").withColumn(
        "at", F.timestamp_seconds(F.col("minute") * 60)
    )
    opening = spark.createDataFrame([(1, 5)], "k long, quantity long")
    found = clamped_balance(df, ["k"], "change", ["at", "id"], opening, before="was", rows=5)
    lag = with_previous(found, ["k"], "quantity", ["at", "id"], "lag").collect()
    assert all(r.was == r["lag"] for r in lag)


def test_a_burst_of_one_second_spreads_over_pieces(spark):
    """A key with 30,000 events in one second, some without a time, beside small keys."""
    df = spark.range(30_000).selectExpr("1 AS k", "CASE WHEN id > 50 THEN timestamp_seconds(1000) END AS at", "id * 7919 % 30000 AS id")
    small = spark.range(300).selectExpr("2 + id % 100 AS k", "timestamp_seconds(id) AS at", "id")
    cut = with_pieces(df.unionByName(small), ["k"], ["at", "id"], "piece", rows=1000)
    assert cut.filter("k > 1 AND piece > 0").count() == 0
    ends = cut.filter("k = 1").groupBy("piece").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("at", "id")).alias("first"), F.max(F.struct("at", "id")).alias("last")
    )
    found = sorted(ends.collect(), key=lambda r: r.piece)
    assert 25 <= len(found) <= 30 and max(r.n for r in found) < 3000
    placed = [(r.first.at is not None, r.first.id, r.last.at is not None, r.last.id) for r in found]
    assert all(a[2:] < b[:2] for a, b in zip(placed, placed[1:], strict=False))
    events = df.withColumn("change", F.when(F.col("id") % 3 == 0, -5).otherwise(2).cast("long"))
    folded = clamped_balance(events, ["k"], "change", ["at", "id"], rows=1000)
    level, expected = 0, {}
    for e in sorted(events.collect(), key=lambda r: (r.at is not None, r.id)):
        level = max(0, level + e.change)
        expected[e.id] = level
    assert {r.id: r.quantity for r in folded.collect()} == expected


def test_equal_rows_share_a_piece(spark):
    df = spark.range(5000).selectExpr("NULL AS k", "id % 3 AS at").withColumn("k", F.col("k").cast("long"))
    cut = with_pieces(df, ["k"], ["at"], "piece", rows=100)
    assert cut.select("at", "piece").distinct().count() == 3 and cut.count() == 5000


@pytest.mark.parametrize("rows_a_piece", [1 << 20, 2])
def test_previous_and_changes_across_pieces(spark, rows_a_piece):
    minutes = [0, 1, 59, 60, 61, 300, 301, 302]
    levels = [5, 5, 3, 3, 8, 8, 9, 0]
    df = spark.createDataFrame([(1, m, i, v) for i, (m, v) in enumerate(zip(minutes, levels))], "k long, m int, id long, level long")
    df = df.withColumn("at", F.timestamp_seconds(F.col("m") * 60))
    found = {r.id: r.p for r in with_previous(df, ["k"], "level", ["at", "id"], "p", rows_a_piece).collect()}
    assert [found[i] for i in range(8)] == [None, *levels[:-1]]
    log = {r.id: (r.change_amount, r.new_stock_level, r.reason) for r in level_changes(df, ["k"], "level", ["at", "id"], rows_a_piece).collect()}
    assert log == {2: (-2, 3, "CONSUMPTION"), 4: (5, 8, "RESTOCK"), 6: (1, 9, "RESTOCK"), 7: (-9, 0, "CONSUMPTION")}


# ---- table maintenance ------------------------------------------------------------


def test_upsert_keeps_other_columns_and_is_idempotent(spark):
    base = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "id int, name string, keep int")
    new = spark.createDataFrame([(2, None), (3, "c")], "id int, name string")
    once = upsert(base, new, ["id"], ["name"])
    assert rows(once) == [(1, "a", 10), (2, None, 20), (3, "c", None)]
    assert rows(upsert(once, new, ["id"], ["name"])) == rows(once)


def test_insert_absent_takes_first_and_only_new(spark):
    base = spark.createDataFrame([(1, "x")], "id int, v string")
    new = spark.createDataFrame([(1, "y", 1), (2, "late", 2), (2, "early", 1)], "id int, v string, o int")
    assert rows(insert_absent(base, new, ["id"], order=["o"])) == [(2, "early")]


def test_update_from_and_where(spark):
    base = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "id int, n int")
    delta = spark.createDataFrame([(1, 15)], "id int, d int")
    assert rows(update_from(base, delta, ["id"], {"n": F.col("n") - F.col("d")})) == [(1, -5), (2, 20), (3, None)]
    assert rows(update_where(base, F.col("n") > 15, {"n": F.lit(0)})) == [(1, 10), (2, 0), (3, None)]


def test_patch_changes_only_what_is_supplied(spark):
    base = spark.createDataFrame([(1, "a", 5, None), (2, "b", 6, None)], "id int, name string, n int, at string")
    delta = spark.createDataFrame([(2, None, 9)], "id int, name string, n int")
    assert rows(patch(base, delta, "id", ["name", "n"], {"at": F.lit("now")})) == [(1, "a", 5, None), (2, "b", 9, "now")]


def test_replace_children_and_empty_set(spark):
    base = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (3, 1)], "role int, perm int")
    new = spark.createDataFrame([(1, 3)], "role int, perm int")
    parents = spark.createDataFrame([(1,), (3,)], "role int")
    assert rows(replace_children(base, new, "role")) == [(1, 3), (2, 1), (3, 1)]
    assert rows(replace_children(base, new, "role", parents)) == [(1, 3), (2, 1)]


def test_deletes(spark):
    child = spark.createDataFrame([(1, 1), (2, 2), (3, None)], "id int, parent int")
    gone = spark.createDataFrame([(2,), (9,)], "id int")
    assert rows(delete_cascade(child, gone, "parent")) == [(1, 1), (3, None)]
    assert rows(delete_set_null(child, gone, "parent")) == [(1, 1), (2, None), (3, None)]


def test_snapshot_diff(spark):
    before = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (4, "d")], "id int, v string")
    after = spark.createDataFrame([(1, "a"), (2, None), (3, None), (5, "e")], "id int, v string")
    found = {r.record_id: (r.action, r.old_value, r.new_value) for r in snapshot_diff(before, after, "id", "t").collect()}
    assert found == {
        3: ("UPDATE", '{"id":3,"v":"c"}', '{"id":3,"v":null}'),
        4: ("DELETE", '{"id":4,"v":"d"}', None),
        5: ("CREATE", None, '{"id":5,"v":"e"}'),
    }


def test_stock_changes(spark):
    before = spark.createDataFrame([(1, 1, 5), (1, 2, 5), (1, 3, 5)], "s int, p int, quantity int")
    after = spark.createDataFrame([(1, 1, 7), (1, 2, 1), (1, 3, 5), (2, 1, 4), (2, 2, 0)], "s int, p int, quantity int")
    found = stock_changes(before, after, ["s", "p"]).drop("created_by")
    assert rows(found) == [(1, 1, 2, "import"), (1, 2, -4, "sale"), (2, 1, 4, "import")]


# ---- lists ------------------------------------------------------------------------


def test_pages(spark):
    df = spark.createDataFrame([(i, i // 3) for i in range(20)], "id int, t int")
    order = [pg_desc("t"), pg_desc("id")]
    assert [r.id for r in page(df, order, 5).collect()] == [19, 18, 17, 16, 15]
    assert [r.id for r in page(df, order, 5, 5).collect()] == [14, 13, 12, 11, 10]
    assert [r.id for r in page_after(df, "t", "id", 5, (5, 15)).collect()] == [14, 13, 12, 11, 10]
    assert rows(page_info(df, 2, 6)) == [(2, 6, 20, 4)]
    assert rows(page_info(df.limit(0), 1, 6)) == [(1, 6, 0, 0)]


def test_null_order(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "v int")
    assert [r.v for r in df.orderBy(pg_asc("v")).collect()] == [1, 2, None]
    assert [r.v for r in df.orderBy(pg_desc("v")).collect()] == [None, 2, 1]


def test_combinations_and_numbered(spark):
    left, right = spark.range(7).toDF("a"), spark.range(5).toDF("b")
    assert rows(combinations(left, right)) == sorted(((a, b) for a in range(7) for b in range(5)), key=str)
    df = spark.createDataFrame([("x", 2), ("y", 0), ("z", None)], "k string, n int")
    assert rows(numbered(df, F.col("n"), "i").select("k", "i")) == [("x", 1), ("x", 2)]


def test_weighted_sample_follows_weights(spark):
    df = spark.range(4000).selectExpr("id", "id % 2 AS g", "IF(id % 4 < 2, 9, 1) AS w", "'all' AS one")
    picked = weighted_sample(df, "w", 400, ["one"], "id", seed=1)
    heavy = picked.filter("w = 9").count()
    assert picked.count() == 400 and 330 < heavy < 390
    assert rows(picked.select("id")) == rows(weighted_sample(df, "w", 400, ["one"], "id", seed=1).select("id"))
    assert weighted_sample(df, "w", 3, ["g"], "id").count() == 6
    assert weighted_sample(df.withColumn("w", F.lit(0)), "w", 3, ["g"], "id").count() == 0
    plan = weighted_sample(df, "w", 3, ["g"], "id")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


# ---- rules and functions ------------------------------------------------------------


def test_user_rules(spark):
    data = [
        (1, "Ann", "a@b.co", "longenough", "3"),
        (2, " A ", "a b@c.d", "short", ""),
        (3, None, None, None, None),
        (4, "Bo", "a@b@c.d", "12345678", "1.5"),
        (5, "Bo", "a@b.c ", "12345678", "0"),
        (6, "Bo", "a@.b.c", "12345678", " 0x1f "),
    ]
    df = validate(spark.createDataFrame(data, "id int, name string, email string, password string, role_id string"), user_rules())
    found = {r.id: [e.split()[0] for e in r.errors] for r in df.collect()}
    assert found == {
        1: [],
        2: ["Name", "Invalid", "Password", "Valid"],
        3: ["Name", "Invalid", "Password", "Valid"],
        4: ["Invalid", "Valid"],
        5: ["Invalid", "Valid"],
        6: [],
    }
    assert accepted(df).count() == 2 and rejected(df).count() == 4


def test_inventory_and_ledger_rules(spark):
    data = [(1, "1", "2", "3", None), (2, "0", "x", "-1", "2.5"), (3, "1", "1", None, "-0"), (4, "1", "1", "1e2", "7.0")]
    df = spark.createDataFrame(data, "id int, store_id string, product_id string, quantity string, low_stock string")
    assert {r.id: len(r.errors) for r in validate(df, inventory_rules()).collect()} == {1: 0, 2: 4, 3: 1, 4: 0}
    events = spark.createDataFrame([(1, 1, 1, 5, "sale"), (2, 1, 1, None, "gift")], "id int, store_id int, product_id int, change_amount int, type string")
    assert {r.id: len(r.errors) for r in validate(events, ledger_rules(LEDGER_TYPES)).collect()} == {1: 0, 2: 2}
    assert rows(missing_fields(events.select("id", "change_amount"), ["id", "change_amount"]).select("id", F.size("missing"))) == [(1, 0), (2, 1)]


def test_whole_numbers(spark):
    good = ["7", "-7", "7.", "7.0", "7e2", " 7 ", "", "0x1F", "0b10", "+3"]
    bad = ["x", "7.5", "1e", "7 7", "NaN", "Infinity", "1e999", "0xg", "7d", None]
    df = spark.createDataFrame([(v,) for v in good + bad], "v string").select("v", is_whole_number(F.col("v")).alias("w"))
    assert [r.w for r in df.collect()] == [True] * len(good) + [False] * len(bad)


def test_trim_sanitize_and_email(spark):
    df = spark.createDataFrame([(JS_SPACE + "<b>x y</b>" + JS_SPACE, 1)], "t string, n int")
    assert rows(sanitize(df)) == [("bx y/b", 1)]
    assert df.select(js_trim(F.col("t")).alias("t")).first().t == "<b>x y</b>"
    assert df.select(is_email(F.lit("a@b.c\n")).alias("e")).first().e is False


def test_duplicates_and_orphans(spark):
    df = spark.createDataFrame([(1, 1), (2, 1), (2, 2), (3, None)], "id int, parent int")
    assert rows(duplicate_keys(df, ["id"])) == [(2, 2)]
    assert rows(orphans(df, spark.createDataFrame([(1,)], "id int"), "parent")) == [(2, 2)]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**9), st.integers(0, 10**9), st.integers(0, 10**9)), min_size=1, max_size=50))
def test_discount_share_is_exact(spark, data):
    from fractions import Fraction
    from math import floor

    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "i int, a long, p long, w long")
    cents = [F.col(c).cast("decimal(18,0)") for c in "apw"]
    found = {r.i: r.s for r in df.select("i", share_cents(*cents).alias("s")).collect()}
    for i, (a, p, w) in enumerate(data):
        assert found[i] == (floor(Fraction(a * p, w) + Fraction(1, 2)) if w else None)


def test_percent_change_and_money(spark):
    df = spark.createDataFrame([(110.0, 100.0), (5.0, 0.0), (5.0, None)], "n double, o double")
    values = [r.p for r in df.select(percent_change(F.col("n"), F.col("o")).alias("p")).collect()]
    assert [round(v, 6) for v in values] == [10.0, 0.0, 0.0]
    assert [str(r[0]) for r in spark.range(1).select(as_money(F.lit("2.675").cast("decimal(10,3)"))).collect()] == ["2.68"]
