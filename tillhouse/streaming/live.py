"""Continuous results: spike alerts, running totals and the stock change log."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions import as_money
from ..operators import keep_first
from ..operators.folds import level_changes, with_previous
from ..plans import pos
from ..sinks import storage
from .commits import Commit, CommitLog

def spike_stream(events: DataFrame, window: str = "5 seconds", threshold: int = 20, lateness: str = "1 minute") -> DataFrame:
    """Spike alerts by event time: the result does not depend on how the stream is
    cut into batches. A window is final ``lateness`` after its end."""
    return pos.spike_alerts(events.withWatermark("event_ts", lateness), "event_ts", window, threshold)


def running_totals(events: DataFrame) -> DataFrame:
    """Sales per branch so far, for ``update`` mode. The state is one row per branch."""
    total = as_money(F.col("unit_price").cast("decimal(10,2)") * F.col("quantity"))
    return events.groupBy("branch_id").agg(
        F.count(F.lit(1)).alias("transactions"),
        F.sum("quantity").alias("units"),
        F.sum(total).alias("revenue"),
    )


LEVEL_KEY = ["branch_id", "product_id"]
LEVEL_ORDER = ["created_at", "id"]
LEVEL = "branch_id long, product_id long, id long, stock_level long, created_at timestamp"
CHANGE = (
    "branch_id long, product_id long, created_at timestamp, id long, change_amount long, new_stock_level long, "
    "reason string, sign int"
)


@dataclass(frozen=True)
class StockLog:
    """Change log of a stream of stock levels (branch_id, product_id, id, stock_level,
    created_at), batch by batch below ``folder``, which executors share.

    Levels may come in any order and any cut into batches: the log nets to that of all
    levels at once. The last level of each key is kept in ``buckets`` by hash of the key,
    of which a batch reads and writes those it has keys of. Keys whose levels come in
    order of time need no more. For the others, the levels since the one before the
    earliest new one are read again, and changes that no longer hold are taken back by
    rows with ``sign`` -1.

    A level that is there already, by key, time and id, is left out; one without any of
    these goes to ``rejects``. A batch is visible as a whole, by its commit record, and
    does nothing if it runs again. A stream that starts over needs a new folder.
    """

    folder: str
    buckets: int = 64
    fan: int = 16

    @property
    def log(self) -> CommitLog:
        return CommitLog(f"{self.folder}/commits", self.fan)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(c).cast("long") for c in LEVEL_KEY]), F.lit(self.buckets)).cast("int")

    def _place(self, name: str, commit: Commit) -> str:
        return f"{self.folder}/{name}/seq={commit.seq}/attempt={commit.attempt}"

    def _write_buckets(self, df: DataFrame, name: str, commit: Commit) -> None:
        """A file for each bucket that ``df`` has rows of."""
        placed = df.withColumns({"bucket": self._bucket(), "seq": F.lit(commit.seq), "attempt": F.lit(commit.attempt)})
        writer = placed.repartition("bucket").write.mode("append")
        writer.partitionBy("bucket", "seq", "attempt").parquet(f"{self.folder}/{name}")

    def _last_levels(self, spark: SparkSession, touched: list[int]) -> DataFrame:
        """The last level of every key of these buckets."""
        versions = {b: storage.names(spark, f"{self.folder}/state/bucket={b}") for b in touched}
        numbers = {b: sorted((int(n[4:]) for n in found), reverse=True) for b, found in versions.items()}
        # A broken attempt may have left the newest one or two; older ones go.
        committed = {c.seq: c for c in self.log.some(spark, sorted({n for own in numbers.values() for n in own[:3]}))}
        paths = []
        for b, own in numbers.items():
            for n in own[:3]:
                path = f"{self.folder}/state/bucket={b}/seq={n}/attempt={committed[n].attempt if n in committed else ''}"
                if n in committed and storage.exists(spark, path):
                    paths.append(path)
                    break
            for n in own[3:]:
                storage.delete(spark, f"{self.folder}/state/bucket={b}/seq={n}")
        return spark.read.schema(LEVEL).parquet(*paths) if paths else spark.createDataFrame([], LEVEL)

    def _history(self, spark: SparkSession, late: DataFrame) -> DataFrame:
        """Stored levels of keys with late ones, from the last before the earliest of those."""
        buckets = [r[0] for r in late.select(self._bucket().alias("b")).distinct().collect()]
        if not storage.exists(spark, f"{self.folder}/levels"):
            return spark.createDataFrame([], LEVEL)
        stored = spark.read.schema(f"{LEVEL}, bucket int, seq long, attempt string").parquet(f"{self.folder}/levels")
        stored = stored.filter(F.col("bucket").isin(buckets)).join(self.log.records(spark), ["seq", "attempt"])
        own = stored.join(late, LEVEL_KEY).withColumn("_at", F.struct(*LEVEL_ORDER))
        before = own.filter("_at < _earliest").groupBy(*LEVEL_KEY).agg(F.max("_at").alias("_from"))
        own = own.join(before, LEVEL_KEY, "left").filter("_from IS NULL OR _at >= _from")
        return own.select("branch_id", "product_id", "id", "stock_level", "created_at")

    def process(self, levels: DataFrame, epoch: int) -> None:
        spark, log = levels.sparkSession, self.log
        if levels.isEmpty() or epoch <= log.last_epoch(spark, ""):
            return
        commit = Commit(log.head(spark) + 1, "", epoch, uuid.uuid4().hex)
        columns = [f"CAST({f.name} AS {f.dataType.simpleString()}) {f.name}" for f in T.StructType.fromDDL(LEVEL)]
        rows = levels.selectExpr(*columns).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            complete = reduce(and_, [F.col(c).isNotNull() for c in [*LEVEL_KEY, *LEVEL_ORDER]])
            rejected = rows.filter(~complete)
            if not rejected.isEmpty():
                rejected.write.mode("overwrite").parquet(self._place("rejects", commit))
            good = keep_first(rows.filter(complete), [*LEVEL_KEY, *LEVEL_ORDER], [F.col("stock_level")])
            self._write_batch(good.persist(StorageLevel.MEMORY_AND_DISK), commit)
            good.unpersist()
            log.append(spark, commit)
        finally:
            rows.unpersist()
        log.fold(spark)

    def _write_batch(self, rows: DataFrame, commit: Commit) -> None:
        spark = rows.sparkSession
        touched = [r[0] for r in rows.select(self._bucket().alias("b")).distinct().collect()]
        last = self._last_levels(spark, touched)
        of_last = last.select(*LEVEL_KEY, F.struct(*LEVEL_ORDER).alias("_last_at"), F.col("stock_level").alias("_last"))
        earliest = rows.groupBy(*LEVEL_KEY).agg(F.min(F.struct(*LEVEL_ORDER)).alias("_earliest"))
        late = earliest.join(of_last, LEVEL_KEY).filter("_earliest <= _last_at").select(*LEVEL_KEY, "_earliest")
        late = late.persist(StorageLevel.MEMORY_AND_DISK)

        in_order = with_previous(rows.join(late, LEVEL_KEY, "left_anti"), LEVEL_KEY, "stock_level", LEVEL_ORDER, "_within")
        in_order = in_order.join(of_last, LEVEL_KEY, "left").withColumn("_before", F.coalesce("_within", "_last"))
        changes = level_changes(in_order, LEVEL_KEY, "stock_level", LEVEL_ORDER, before="_before").withColumn("sign", F.lit(1))
        new = rows
        if not late.isEmpty():
            old = self._history(spark, late).persist(StorageLevel.MEMORY_AND_DISK)
            more = rows.join(late, LEVEL_KEY, "left_semi").join(old, [*LEVEL_KEY, *LEVEL_ORDER], "left_anti").select(*old.columns)
            now = level_changes(old.unionByName(more), LEVEL_KEY, "stock_level", LEVEL_ORDER).withColumn("sign", F.lit(1))
            then = level_changes(old, LEVEL_KEY, "stock_level", LEVEL_ORDER).withColumn("sign", F.lit(-1))
            same = [c for c in now.columns if c != "sign"]
            moved = now.unionByName(then).groupBy(*same).agg(F.sum("sign").cast("int").alias("sign")).filter("sign <> 0")
            changes = changes.unionByName(moved)
            new = rows.join(late, LEVEL_KEY, "left_anti").select(*old.columns).unionByName(more)
        changes.write.mode("overwrite").parquet(self._place("log", commit))
        self._write_buckets(new, "levels", commit)
        newest = last.unionByName(rows.select(*last.columns)).groupBy(*LEVEL_KEY).agg(
            F.max_by(F.struct("id", "stock_level", "created_at"), F.struct(*LEVEL_ORDER)).alias("_n")
        )
        self._write_buckets(newest.select(*LEVEL_KEY, "_n.*"), "state", commit)

    def changes(self, spark: SparkSession) -> DataFrame:
        """The log as written, changes taken back included: ``sign`` is 1 or -1."""
        rows = spark.read.schema(f"{CHANGE}, seq long, attempt string").parquet(f"{self.folder}/log")
        return rows.join(self.log.records(spark), ["seq", "attempt"]).drop("attempt", "run")

    def read(self, spark: SparkSession) -> DataFrame:
        """The changes that hold. Only keys of which some were taken back are added up."""
        rows = self.changes(spark).drop("seq", "epoch_id")
        back = rows.filter("sign < 0").select(*LEVEL_KEY).distinct()
        same = [c for c in rows.columns if c != "sign"]
        netted = rows.join(back, LEVEL_KEY, "left_semi").groupBy(*same).agg(F.sum("sign").alias("sign")).filter("sign > 0")
        return rows.join(back, LEVEL_KEY, "left_anti").select(*same).unionByName(netted.select(*same))


def start_stock_log(
    levels: DataFrame, target: StockLog, checkpoint: str, interval: str | None = "5 seconds"
) -> StreamingQuery:
    """Run the log; ``interval=None`` works off what is there and stops."""
    writer = levels.writeStream.outputMode("append").foreachBatch(target.process).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()
