"""Sinks, catalog helpers and the streaming pipeline."""

import datetime as dt
import json
import os
import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tillhouse import sinks, sources
from tillhouse.operators.folds import level_changes
from tillhouse.plans import pos
from tillhouse.sinks import storage
from tillhouse.sources import DriverTables, json_file_stream
from tillhouse.streaming import (
    Commit,
    CommitLog,
    Gate,
    Ingest,
    StockLog,
    current_stock,
    running_totals,
    spike_stream,
    start_ingest,
    start_stock_log,
    unmatched_moves,
)

FOLDER = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# ---- sinks --------------------------------------------------------------------


def test_overwrite_reload_and_append(spark, folder):
    path = folder + "/fact"
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "day int, v string")
    sinks.overwrite_table(df, path, ["day"])
    sinks.reload_partitions(spark.createDataFrame([(2, "z")], "day int, v string"), path, ["day"])
    assert rows(spark.read.parquet(path).select("day", "v")) == [(1, "a"), (1, "b"), (2, "z")]
    sinks.append_table(spark.createDataFrame([(3, "n")], "day int, v string"), path, ["day"])
    assert spark.read.parquet(path).count() == 4
    sinks.overwrite_table(df, path, ["day"])
    assert rows(spark.read.parquet(path).select("day", "v")) == rows(df)


def test_range_reload_empties_days_without_rows(spark, folder):
    path = folder + "/fact"
    sinks.overwrite_table(spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "day int, v string"), path, ["day"])
    sinks.reload_range(spark.createDataFrame([(1, "z"), (9, "out of range")], "day int, v string"), path, "day", 1, 2)
    assert rows(spark.read.parquet(path).select("day", "v")) == [(1, "z"), (3, "c")]


def test_half_year_partitions_are_pruned(spark, folder):
    orders = DriverTables(spark, FOLDER).order_headers
    sinks.overwrite_table(sinks.with_half_year(orders, "created_at"), folder + "/orders", ["year", "half"])
    part = spark.read.parquet(folder + "/orders").filter("year = 1998 AND half = 2")
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    expected = orders.filter("created_at >= TIMESTAMP_NTZ'1998-07-01' AND created_at < TIMESTAMP_NTZ'1999-01-01'")
    assert part.count() == expected.count() > 0


def test_logged_write_counts_in_passing(spark, folder):
    df = spark.range(123)
    n = sinks.logged_write(df, lambda d: sinks.overwrite_table(d, folder + "/t"), folder + "/log", "BULK_SEED", "test rows")
    log = spark.read.parquet(folder + "/log").collect()
    assert n == 123 and [(r.event_type, r.records_affected) for r in log] == [("BULK_SEED", 123)]


def test_catalog_helpers(spark, folder):
    spark.range(3).createOrReplaceTempView("some_view")
    assert "some_view" in sources.list_tables(spark)
    assert sources.needs_seed(spark.range(0)) and not sources.needs_seed(spark.range(1))
    spark.range(5).write.parquet(folder + "/a")
    assert sources.load_tables(spark, folder, ["a"])["a"].count() == 5


def test_jdbc_needs_bounds(spark):
    with pytest.raises(ValueError, match="bound"):
        sources.read_jdbc(spark, "jdbc:x", "t", {}, partition_column="id")


# ---- streams --------------------------------------------------------------------


def _event(i, branch=1, product=1, quantity=1, price=2.5, at="2026-01-01T10:00:00"):
    return json.dumps(
        {"transaction_id": f"t{i}", "branch_id": branch, "product_id": product, "quantity": quantity, "unit_price": price, "timestamp": at}
    )


def _drop(folder, name, lines):
    """Add a file; a stream reads files by age, so number them in that order."""
    path = Path(folder, "in", name)
    path.parent.mkdir(exist_ok=True)
    path.write_text("\n".join(lines) + "\n")
    written = 1_700_000_000 + int(path.stem)
    os.utime(path, (written, written))


def _run(spark, folder, checkpoint="checkpoint", **options):
    target = Ingest(folder + "/out", **options)
    lines = json_file_stream(spark, folder + "/in", files_per_trigger=1)
    query = start_ingest(lines, target, f"{folder}/{checkpoint}", interval=None)
    query.awaitTermination()
    return target


def test_ingest_is_idempotent_across_batches_restarts_and_runs(spark, folder):
    first = [_event(1, quantity=15), _event(2, quantity=6), _event(1, quantity=15), "{broken", _event(3, branch=None), _event(4, at="never")]
    first += [_event(7, quantity=0), _event(8, price=-1.0), _event(9, price=1e15), _event(10, price=9e7, quantity=100)]
    _drop(folder, "1.json", first)
    _drop(folder, "2.json", [_event(2, quantity=6), _event(5, branch=2, quantity=3)])
    target = _run(spark, folder)
    _drop(folder, "3.json", [_event(1, quantity=15), _event(6, product=2)])
    _run(spark, folder)
    assert rows(target.read(spark, "staged").select("transaction_id")) == [("t1",), ("t2",), ("t5",), ("t6",)]
    assert rows(target.read(spark, "orders").select("order_id", "gross_amount").selectExpr("order_id", "CAST(gross_amount AS double)")) == [
        ("t1", 37.5), ("t2", 15.0), ("t5", 7.5), ("t6", 2.5),
    ]
    assert target.read(spark, "order_items").count() == 4
    assert target.read(spark, "rejects").count() == 7
    assert rows(target.read(spark, "spikes").select("branch_id", "units")) == [(1, 36)]

    opening = spark.createDataFrame([(1, 1, 20), (1, 2, 20), (3, 3, 5)], "branch_id int, product_id int, stock_level long")
    assert rows(current_stock(opening, target.moves(spark))) == [(1, 1, -1), (1, 2, 19), (3, 3, 5)]

    again = _run(spark, folder, "new-checkpoint")  # reads every file again, under the same run name
    assert again.read(spark, "staged").count() == 4
    assert again.read(spark, "orders").count() == 4
    assert rows(unmatched_moves(opening, again.moves(spark))) == [(2, 1, 3)]
    # a batch that is processed a second time does nothing
    lines = spark.createDataFrame([(x,) for x in first], "value string")
    before = rows(target.log.records(spark))
    again = target.of_stream(spark, folder + "/checkpoint")
    again.process(lines, 0)
    assert rows(target.log.records(spark)) == before and target.read(spark, "staged").count() == 4


def _put(spark, target, epoch, events):
    target.process(spark.createDataFrame([(e,) for e in events], "value string"), epoch)


def test_ids_of_any_age_are_known_and_few_buckets_are_read(spark, folder):
    """Batches of every age, folded two levels deep; old ids and dates far off come again."""
    target = Ingest(folder + "/out", fan=3)
    target.prepare(spark)
    for epoch in range(11):
        day = 1 + epoch
        at = "2099-01-01T00:00:00" if epoch == 4 else f"2026-01-{day:02}T08:00:00"
        _put(spark, target, epoch, [_event(f"{epoch}-{k}", branch=k % 3, at=at) for k in range(6)] + [_event("0-0")])
    assert target.read(spark, "staged").count() == 11 * 6
    assert target.log.head(spark) == 11
    segments, single = target.ids(spark).segments().live(11)
    assert [(s.level, s.first, s.last) for s in segments] == [(2, 1, 9)] and single == [10, 11]
    index = target.ids(spark)
    folder_of_ids = index.segments().path(segments[0]) + "/ids"
    buckets = [n for n in storage.names(spark, folder_of_ids) if n.startswith("bucket=")]
    one = spark.createDataFrame([("t3-1",)], "transaction_id string")
    assert len(index.buckets_to_read(one, 11)) == 1 < len(buckets)
    unknown = spark.createDataFrame([(f"new{k}",) for k in range(20)], "transaction_id string")
    assert len(index.buckets_to_read(unknown, 11)) <= 3  # what the filters let through by mistake
    _put(spark, target, 11, [_event("2-1"), _event("9-5"), _event("10-3"), _event("new", at="1999-01-01T00:00:00")])
    staged = rows(target.read(spark, "staged").filter("epoch_id = 11").select("transaction_id"))
    assert staged == [("tnew",)]
    _put(spark, target, 12, [])
    assert target.log.head(spark) == 12


def test_filters_pass_all_ids_and_few_others(spark, folder):
    target = Ingest(folder + "/out", fan=2)
    target.prepare(spark)
    ids = spark.range(20_000).selectExpr("concat('id-', id) AS transaction_id")
    for seq in (1, 2):
        own = ids.filter(f"hash(transaction_id) % 2 = 0 = ({seq} = 1)")
        commit = Commit(seq, "main", seq, "a")
        target._write(own, "staged", commit)
        target.log.append(spark, commit)
    index = target.ids(spark)
    index.fold(2)
    assert index.known(ids, 2).count() == 20_000
    path = index.segments().path(index.segments().live(2)[0][0])
    assert sum(f.startswith("slots=") for f in storage.names(spark, path + "/filters")) == 1
    others = spark.range(2_000).selectExpr("concat('other-', id) AS transaction_id")
    hits = 0
    for r in others.sample(0.02, 1).collect():
        hits += len(index.buckets_to_read(spark.createDataFrame([r], "transaction_id string"), 2))
    assert hits <= 4
    assert index.known(others, 2).count() == 0


TABLES_OF_A_BATCH = ["staged", "orders", "order_items", "stock_moves", "spikes", "batches"]


@pytest.mark.parametrize("broken", TABLES_OF_A_BATCH)
def test_a_batch_killed_between_two_writes_shows_nothing(spark, folder, monkeypatch, broken):
    target = Ingest(folder + "/out")
    target.prepare(spark)
    _put(spark, target, 0, [_event(1, quantity=25)])
    write = Ingest._write

    def killed(self, df, name, commit):
        if name == broken:
            raise OSError("killed")
        write(self, df, name, commit)

    monkeypatch.setattr(Ingest, "_write", killed)
    with pytest.raises(OSError, match="killed"):
        _put(spark, target, 1, [_event(2, quantity=30), "{"])
    monkeypatch.undo()
    for name in [*TABLES_OF_A_BATCH, "rejects"]:
        assert target.read(spark, name).filter("epoch_id = 1").count() == 0
    assert rows(target.moves(spark)) == [(1, 1, 25)]
    _put(spark, target, 1, [_event(2, quantity=30), "{"])
    for name in [*TABLES_OF_A_BATCH, "rejects"]:
        assert target.read(spark, name).filter("epoch_id = 1").count() == 1
    head = target.log.head(spark)
    _put(spark, target, 2, [_event(3)])
    assert target.read(spark, "orders", head).count() == 2  # a reader who keeps to one head
    assert target.read(spark, "orders").count() == 3


def test_a_batch_number_is_given_once(spark, folder):
    log = CommitLog(folder + "/commits", fan=2)
    log.append(spark, Commit(1, "a", 0, "x"))
    with pytest.raises(Exception, match="exist"):
        log.append(spark, Commit(1, "b", 0, "y"))
    storage.publish(spark, folder + "/commits/records/000000000000002.json", "")  # a record that broke off
    log.append(spark, Commit(3, "b", 7, "z"))
    log.append(spark, Commit(4, "a", 5, "w"))
    for _ in range(2):
        assert rows(log.records(spark).select("seq", "run", "epoch_id")) == [(1, "a", 0), (3, "b", 7), (4, "a", 5)]
        assert (log.last_epoch(spark, "a"), log.last_epoch(spark, "b"), log.last_epoch(spark, "c")) == (5, 7, -1)
        assert rows(log.records(spark, 3).select("seq")) == [(1,), (3,)]
        log.fold(spark)
    assert storage.names(spark, folder + "/commits/folded/level=2") == ["last=4"]


def test_stock_of_a_thousand_batches_takes_few_files(spark, folder):
    """Moves of batches that were written and committed before; stock equals their sum."""
    target, n, fan = Ingest(folder + "/out", fan=4), 1000, 4
    target.prepare(spark)
    moves = spark.range(n).selectExpr("CAST(id % 3 AS int) branch_id", "CAST(id % 5 AS int) product_id", "id + 1 AS total_qty", "id + 1 AS seq", "'a' AS attempt")
    moves.repartitionByRange(8, "seq").write.partitionBy("seq", "attempt").mode("append").parquet(target.table("stock_moves"))
    records = Path(target.table("commits"), "records")
    records.mkdir(parents=True)
    for seq in range(1, n + 1):
        (records / f"{seq:015d}.json").write_text(json.dumps({"seq": seq, "run": "main", "epoch_id": seq, "attempt": "a"}) + "\n")
    folded = target._folded_moves(spark)
    assert [(s.level, s.last) for s in folded.planned(n)] == [(4, 256), (4, 512), (4, 768), (3, 832), (3, 896), (3, 960), (2, 976), (2, 992), (1, 996), (1, 1000)]
    for level_of, last in ((4, 256), (4, 512), (4, 768), (2, 976)):  # a fold that breaks off half-way
        folded.write(folded.batches(last - fan**level_of + 1, last), None, f"{folded.folder}/level={level_of}/last={last}")
        storage.publish(spark, f"{folded.folder}/level={level_of}/last={last}/_COMPLETE", "")
    assert len(folded.live(n)[0]) == 4 and len(folded.live(n)[1]) == n - 784
    folded.fold(n)
    found = target.moves(spark)
    expected = rows(moves.groupBy("branch_id", "product_id").agg(F.sum("total_qty")))
    assert rows(found.groupBy("branch_id", "product_id").agg(F.sum("total_qty"))) == expected
    files = found.inputFiles()
    assert len(files) <= 8 * 10 and not any("/stock_moves/" in f for f in files)
    opening = spark.createDataFrame([(b, p, 10**6) for b in range(3) for p in range(5)], "branch_id int, product_id int, stock_level long")
    assert rows(current_stock(opening, found)) == rows(current_stock(opening, moves))


def test_the_gate_keeps_a_bad_batch_out_and_the_stream_goes_on(spark, folder):
    _drop(folder, "1.json", [_event(i) for i in range(4)])
    _drop(folder, "2.json", [_event(9), "{broken", "{", _event(None), _event(5, quantity=-1)])
    _drop(folder, "3.json", ["{broken", _event(6, quantity=3), _event(7)])
    target = _run(spark, folder, gate=Gate(lines=4, rejected=0.5))
    assert rows(target.read(spark, "staged").select("transaction_id")) == [(f"t{i}",) for i in (0, 1, 2, 3, 6, 7)]
    assert target.read(spark, "quarantine").count() == 5 and target.read(spark, "rejects").count() == 1
    measures = rows(target.read(spark, "batches").select("epoch_id", "lines", "accepted", "staged", "units", "passed"))
    assert measures == [(0, 4, 4, 4, 4, True), (1, 5, 2, 0, 2, False), (2, 3, 2, 2, 4, True)]
    # what was mended can come again later
    _drop(folder, "4.json", [_event(9), _event(5)])
    assert _run(spark, folder, gate=Gate(lines=4, rejected=0.5)).read(spark, "staged").count() == 8


def test_failed_write_ends_the_stream(spark, folder, monkeypatch):
    _drop(folder, "1.json", [_event(1)])

    def fail(self, df, name, commit):
        raise OSError("disk gone")

    monkeypatch.setattr(Ingest, "_write", fail)
    with pytest.raises(Exception, match="disk gone"):
        _run(spark, folder)
    monkeypatch.undo()
    assert _run(spark, folder).read(spark, "staged").count() == 1


def test_stream_equals_batch(spark, folder):
    events = DriverTables(spark, FOLDER).pos_events
    events.select(F.to_json(F.struct("*")).alias("value")).repartition(3).write.text(folder + "/in")
    target = _run(spark, folder)
    staged = target.read(spark, "staged")
    expected = pos.stage(events).withColumn("event_ts", F.col("event_ts").cast("timestamp"))
    assert rows(staged.select(*expected.columns)) == rows(expected)


def _stream_rows(df, folder, mode):
    """Run a stream to the end; the rows of all its batches, in order of batch."""
    seen = []
    query = (
        df.writeStream.outputMode(mode)
        .foreachBatch(lambda batch, epoch: seen.extend((epoch, *r) for r in batch.collect()))
        .option("checkpointLocation", folder + "/cp")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return seen


def test_spike_stream_is_independent_of_batches(spark, folder):
    at = "2026-01-01T10:00:0{}"
    _drop(folder, "1.json", [_event(1, quantity=12, at=at.format(1))])
    _drop(folder, "2.json", [_event(2, quantity=8, at=at.format(4)), _event(3, quantity=9, at=at.format(6))])
    _drop(folder, "3.json", [_event(4, at="2026-01-01T11:00:00")])
    events = pos.parse_events(json_file_stream(spark, folder + "/in", 1)).withColumn("event_ts", F.to_timestamp("timestamp"))
    found = [(r[1], r[2], r[3]) for r in _stream_rows(spike_stream(events), folder, "append")]
    assert found == [(dt.datetime(2026, 1, 1, 10, 0), 1, 20)]


def test_running_totals_end_at_the_batch_result(spark, folder):
    _drop(folder, "1.json", [_event(i, branch=i % 2, quantity=i) for i in range(6)])
    _drop(folder, "2.json", [_event(i, branch=i % 3, quantity=i) for i in range(6, 12)])
    stream = running_totals(pos.parse_events(json_file_stream(spark, folder + "/in", 1)))
    last = {r[1]: r[1:] for r in _stream_rows(stream, folder, "update")}
    batch = running_totals(pos.parse_events(spark.read.text(folder + "/in")))
    assert sorted(last.values()) == rows(batch)


def test_stock_log_stream_equals_batch_log(spark, folder):
    levels = [(1, 1, i, v, f"2026-01-01 10:0{i}:00") for i, v in enumerate([10, 10, 7, 9])] + [
        (1, 1, 4, 9, "2026-01-01 11:00:00"), (1, 1, 5, 2, "2026-01-01 11:01:00"), (2, 1, 6, 5, "2026-01-01 11:00:00"),
    ]
    schema = "branch_id long, product_id long, id long, stock_level long, created_at string"
    for part, chosen in enumerate((levels[:4], levels[4:])):
        df = spark.createDataFrame(chosen, schema).coalesce(1)
        df.write.mode("append").json(f"{folder}/in/part={part}")
    stream = spark.readStream.schema(schema + ", part int").option("maxFilesPerTrigger", 1).json(folder + "/in")
    stream = stream.withColumn("created_at", F.to_timestamp("created_at"))
    target = StockLog(folder + "/stock")
    start_stock_log(stream.drop("part"), target, folder + "/cp", interval=None).awaitTermination()
    columns = ["branch_id", "product_id", "id", "change_amount", "new_stock_level", "reason"]
    expected = [(1, 1, 2, -3, 7, "CONSUMPTION"), (1, 1, 3, 2, 9, "RESTOCK"), (1, 1, 5, -7, 2, "CONSUMPTION")]
    assert rows(target.read(spark).select(*columns)) == expected
    # a batch that runs again does nothing
    again = spark.read.schema(schema).json(folder + "/in/part=1").withColumn("created_at", F.to_timestamp("created_at"))
    target.process(again, 1)
    assert rows(target.read(spark).select(*columns)) == expected


def _levels(rng, n, keys):
    """Random levels at times that repeat, for few keys; some come twice."""
    found = []
    for i in range(n):
        at = dt.datetime(2026, 1, 1) + dt.timedelta(minutes=rng.randrange(n // 2))
        found.append((rng.randrange(keys), rng.randrange(2), i, rng.randrange(6), at))
    return found + rng.sample(found, n // 10)


@pytest.mark.parametrize("shuffled, cuts", [(True, 5), (False, 4), (True, 1)])
def test_stock_log_of_any_cut_is_that_of_all_levels(spark, folder, shuffled, cuts):
    rng = random.Random(cuts)
    levels = _levels(rng, 120, 6)
    levels.sort(key=lambda r: (r[4], r[2]))
    if shuffled:
        rng.shuffle(levels)
    schema = "branch_id long, product_id long, id long, stock_level long, created_at timestamp"
    target = StockLog(folder + "/stock", buckets=4, fan=3)
    at = sorted(rng.sample(range(1, len(levels)), cuts - 1)) if cuts > 1 else []
    for epoch, (lo, hi) in enumerate(zip([0, *at], [*at, len(levels)], strict=True)):
        target.process(spark.createDataFrame(levels[lo:hi], schema), epoch)
    everything = spark.createDataFrame(levels, schema).distinct()
    expected = level_changes(everything, ["branch_id", "product_id"], "stock_level", ["created_at", "id"])
    found = target.read(spark)
    assert rows(found.select(*expected.columns)) == rows(expected)
    taken_back = target.changes(spark).filter("sign < 0").count()
    assert (taken_back > 0) == (shuffled and cuts > 1)


def test_stock_log_writes_only_buckets_it_has_keys_of(spark, folder):
    schema = "branch_id long, product_id long, id long, stock_level long, created_at timestamp"
    target = StockLog(folder + "/stock", buckets=16)
    start = dt.datetime(2026, 1, 1)
    target.process(spark.createDataFrame([(b, p, b * 50 + p, 5, start) for b in range(20) for p in range(50)], schema), 0)
    buckets = storage.names(spark, folder + "/stock/state")
    assert sum(n.startswith("bucket=") for n in buckets) == 16
    target.process(spark.createDataFrame([(3, 7, 5000, 9, start + dt.timedelta(1)), (3, 7, 5001, 8, start - dt.timedelta(1)), (None, 7, 1, 1, start)], schema), 1)
    written = [p for p in Path(folder, "stock").rglob("seq=2/**/part-*") if p.suffix == ".parquet"]
    places = Counter(p.relative_to(folder + "/stock").parts[0] for p in written)
    assert set(places) == {"levels", "log", "rejects", "state"} and places["levels"] == places["state"] == 1
    found = rows(target.read(spark).select("branch_id", "id", "change_amount", "new_stock_level", "reason"))
    assert found == [(3, 157, -3, 5, "CONSUMPTION"), (3, 5000, 4, 9, "RESTOCK")]
