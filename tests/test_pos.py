"""Cleaning and features on a small batch worked out by hand, and edge rows."""

import datetime as dt
from collections import defaultdict

from tillhouse.plans import features, pos
from tillhouse.schemas import POS_EVENT
from tillhouse.sources import read_json_lake, split_corrupt

# Two branches, two products, nine days; one event arrives twice, one is free of charge.
DAYS = ["03-02", "03-03", "03-05", "03-06", "03-07", "03-09", "03-10", "03-11", "03-12"]
BATCH = [(f"a{i}", 1, 7, i % 4 + 1, 2.50, f"2025-{d} 09:{i:02}:00") for i, d in enumerate(DAYS)]
BATCH += [(f"b{i}", 1, 8, 3, 1.20, f"2025-{d} 17:00:00") for i, d in enumerate(DAYS[:2])]
BATCH += [("b9", 1, 8, 1, 1.20, "2025-03-02 18:00:00"), ("c1", 4, 7, 10, 0.99, "2025-03-05 08:00:00")]
BATCH += [BATCH[0], ("free", 4, 7, 5, 0.0, "2025-03-06 08:00:00")]


def by_hand(batch):
    """Features of the last seven rows of each (branch, product), worked out in plain Python."""
    daily = defaultdict(lambda: [0, 0, 0])
    for _, branch, product, quantity, price, at in {b[0]: b for b in batch if b[4] > 0}.values():
        sums = daily[branch, product, at[:10]]
        sums[0] += round(100 * price) * quantity
        sums[1] += quantity
        sums[2] += 1
    counts = defaultdict(list)
    for (branch, _, _), (_, _, n) in daily.items():
        counts[branch].append(n)
    expected, series = {}, defaultdict(list)
    for (branch, product, day), (cents, units, n) in sorted(daily.items()):
        series[branch, product].append((cents, units))
        last = series[branch, product][-7:]
        mean = sum(counts[branch]) / len(counts[branch])
        expected[day, branch, product] = (
            sum(c for c, _ in last) / 100, round(sum(u for _, u in last) / 7, 4), round(n / mean, 4),
        )
    return expected


def _features(spark, rows, **options):
    daily = pos.daily_sales(pos.clean(spark.createDataFrame(rows, POS_EVENT)))
    found = features.ml_features(daily, **options).collect()
    return {(str(r[0]), r[1], r[2]): (float(r[3]), r[4], r[5]) for r in found}


def test_features_of_known_batch(spark):
    expected = by_hand(BATCH)
    assert len(expected) == 12 and _features(spark, BATCH) == expected


def test_row_frame_spans_gaps_and_day_frame_does_not(spark):
    rows = [("a", 1, 1, 7, 1.0, "2026-01-01 08:00:00"), ("b", 1, 1, 14, 1.0, "2026-03-01 08:00:00")]
    assert _features(spark, rows)["2026-03-01", 1, 1][:2] == (21.0, 3.0)
    assert _features(spark, rows, by_days=True)["2026-03-01", 1, 1][:2] == (14.0, 2.0)


def test_clean_edge_rows(spark):
    rows = [
        ("late", 1, 1, 1, 2.0, "2026-01-02 10:00:00"),
        ("late", 1, 1, 9, 2.0, "2026-01-03 10:00:00"),  # same id, later: loses
        ("free", 1, 1, 1, 0.0, "2026-01-01 10:00:00"),
        ("free", 1, 1, 1, 3.0, "2026-01-01 11:00:00"),  # hidden by the unpriced survivor
        ("none", 1, 1, 1, None, "2026-01-01 10:00:00"),
        ("when", 1, 1, 2, 4.0, "not a time"),
        ("when2", 1, 1, 2, 4.0, None),
        ("iso", 1, 1, 3, 1.5, "2026-01-01T10:00:00.123456"),
    ]
    found = {r.transaction_id: r for r in pos.clean(spark.createDataFrame(rows, POS_EVENT)).collect()}
    assert set(found) == {"late", "when", "when2", "iso"}
    assert found["late"].quantity == 1
    assert found["when"].timestamp is None and found["when"].date is None
    assert found["iso"].timestamp == dt.datetime(2026, 1, 1, 10, 0, 0, 123456)
    assert float(found["iso"].total_price) == 4.5


def test_one_id_with_most_of_the_rows_collapses_before_the_shuffle(spark):
    same = spark.range(200_000).selectExpr(
        "'hot' AS transaction_id", "1 AS branch_id", "1 AS product_id", "1 AS quantity",
        "CAST(1 AS double) AS unit_price", "'2026-01-01 00:00:00' AS timestamp",
    )
    plan = pos.clean(same)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan
    assert pos.clean(same).count() == 1


def test_parse_and_malformed(spark):
    good = '{"transaction_id":"t1","branch_id":1,"product_id":2,"quantity":3,"unit_price":1.5,"timestamp":"2026-01-01"}'
    lines = spark.createDataFrame([(good,), ("{oops",), ('{"branch_id":1}',)], "value string")
    assert [r.transaction_id for r in pos.parse_events(lines).collect()] == ["t1", None, None]
    assert {r.value for r in pos.malformed(lines).collect()} == {"{oops", '{"branch_id":1}'}


def test_json_lake_keeps_corrupt_lines(spark, folder):
    lines = ['{"transaction_id":"t1","quantity":3}', "{broken"]
    spark.createDataFrame([(x,) for x in lines], "value string").write.mode("overwrite").text(folder + "/raw")
    good, bad = split_corrupt(read_json_lake(spark, folder + "/raw").cache())
    assert [r.transaction_id for r in good.collect()] == ["t1"]
    assert [r[0] for r in bad.collect()] == ["{broken"]


def test_spike_alert_windows(spark):
    rows = [(1, "2026-01-01 00:00:01", 15), (1, "2026-01-01 00:00:04", 5), (1, "2026-01-01 00:00:05", 19), (2, "2026-01-01 00:00:02", 19)]
    events = spark.createDataFrame(rows, "branch_id int, t string, quantity int").selectExpr(
        "branch_id", "CAST(t AS timestamp) AS event_ts", "quantity"
    )
    assert [(r.branch_id, r.units) for r in pos.spike_alerts(events).collect()] == [(1, 20)]
