"""Micro-batch ingest of POS events.

A batch writes its rows to all tables under a number and an attempt of its own and then
a commit record, which makes them visible together. A batch that runs again after its
commit does nothing; one that broke before leaves rows that nobody reads. A run is one
checkpoint: its name has the id of the stream that the checkpoint belongs to, so a
stream that starts over never takes the batches of another for its own.

Ids of all history are looked up in an index of buckets with Bloom filters, so an event
of any age is staged once and only buckets that may hold an id are read. Stock moves are
folded into segments, so that the stock of today takes few files. Write errors end the
stream; the checkpoint never moves past lost rows.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, replace
from functools import reduce
from operator import and_

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import update_from
from ..plans import pos
from ..schemas import POS_EVENT, POS_STAGED
from ..sinks import storage
from .commits import Commit, CommitLog
from .id_index import IdIndex
from .segments import Segment, Segments

REQUIRED = ["transaction_id", "branch_id", "product_id", "quantity", "unit_price", "event_ts"]
SPIKE_UNITS = 20


def _acceptable() -> Column:
    """Whether the order tables' constraints hold: nothing missing, a positive
    quantity, no negative price, and amounts that fit their columns."""
    present = reduce(and_, [F.col(c).isNotNull() for c in REQUIRED])
    price = F.col("unit_price").try_cast("decimal(10,2)")
    fits = (price * F.col("quantity")).try_cast("decimal(10,2)").isNotNull()
    return F.coalesce(present & (F.col("quantity") > 0) & (F.col("unit_price") >= 0) & fits, F.lit(False))


MOVES = "branch_id int, product_id int, total_qty long"
TABLES = {
    "staged": POS_STAGED,
    "orders": "order_id string, branch_id int, gross_amount decimal(10,2), discount_amount decimal(10,2), created_at timestamp",
    "order_items": "order_id string, branch_id int, product_id int, quantity int, unit_price decimal(10,2)",
    "stock_moves": MOVES,
    "spikes": "branch_id int, units long",
    "rejects": "value string",
    "quarantine": "value string",
    "batches": "lines long, accepted long, staged long, units long, passed boolean",
}


def _schema(name: str) -> T.StructType:
    kind = TABLES[name]
    return kind if isinstance(kind, T.StructType) else T.StructType.fromDDL(kind)


@dataclass(frozen=True)
class Gate:
    """When a batch as a whole is not to be trusted: of at least ``lines`` lines, more
    than ``rejected`` are unreadable or break a rule."""

    lines: int = 100
    rejected: float = 0.5


@dataclass(frozen=True)
class Ingest:
    """Where the tables live: ``TABLES`` below one folder, beside commits, id index and
    folded stock moves.

    With a ``gate``, the lines of a batch that does not pass go to ``quarantine`` and to
    no other table. ``fan`` says how many batches or segments are folded into one.
    """

    folder: str
    run: str = "main"
    spike_units: int = SPIKE_UNITS
    fan: int = 16
    gate: Gate | None = None

    def table(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def of_stream(self, spark: SparkSession, checkpoint: str) -> Ingest:
        """The same tables for the stream that a checkpoint belongs to."""
        text = spark.read.text(f"{checkpoint}/metadata").first()[0]
        return replace(self, run=f"{self.run}-{json.loads(text)['id']}")

    def prepare(self, spark: SparkSession) -> None:
        """Make the folders of the tables."""
        for name in TABLES:
            storage.make_folder(spark, self.table(name))

    @property
    def log(self) -> CommitLog:
        return CommitLog(self.table("commits"), self.fan)

    # ---- reading ----

    def read(self, spark: SparkSession, name: str, head: int | None = None) -> DataFrame:
        """What committed batches wrote to a table, with ``seq``, ``run`` and ``epoch_id``.
        Several tables read with one ``head`` (see ``CommitLog.head``) fit together."""
        schema = _schema(name)
        keys = [T.StructField("seq", T.LongType()), T.StructField("attempt", T.StringType())]
        rows = spark.read.schema(T.StructType([*schema.fields, *keys])).parquet(self.table(name))
        return rows.join(self.log.records(spark, head), ["seq", "attempt"]).select(*schema.fieldNames(), "seq", "run", "epoch_id")

    def _of_batches(self, spark: SparkSession, name: str, schema: str, first: int, last: int) -> DataFrame:
        """The same for a short range of batches. Only their folders are listed."""
        paths = [self._place(name, c) for c in self.log.some(spark, list(range(first, last + 1)))]
        there = [p for p in paths if storage.exists(spark, p)]
        return spark.read.schema(schema).parquet(*there) if there else spark.createDataFrame([], schema)

    def moves(self, spark: SparkSession) -> DataFrame:
        """All stock moves, most of them already added up: fewer than ``fan`` segments of
        each level, and fewer than ``fan`` batches, are read."""
        folded = self._folded_moves(spark)
        segments, single = folded.live(self.log.head(spark))
        rows = folded.batches(single[0], single[-1]) if single else spark.createDataFrame([], MOVES)
        for s in segments:
            rows = rows.unionByName(folded.read(s, folded.path(s)))
        return rows

    def _folded_moves(self, spark: SparkSession) -> Segments:
        def write(rows: DataFrame, _: Segment, path: str) -> None:
            added = rows.groupBy("branch_id", "product_id").agg(F.sum("total_qty").alias("total_qty"))
            added.write.mode("overwrite").parquet(path)

        def read(_: Segment, path: str) -> DataFrame:
            return spark.read.schema(MOVES).parquet(path)

        def batches(first: int, last: int) -> DataFrame:
            return self._of_batches(spark, "stock_moves", MOVES, first, last)

        return Segments(spark, self.table("folded_moves"), self.fan, batches, write, read)

    def ids(self, spark: SparkSession) -> IdIndex:
        def staged(first: int, last: int) -> DataFrame:
            return self._of_batches(spark, "staged", "transaction_id string", first, last)

        return IdIndex(spark, self.table("ids"), self.fan, staged)

    # ---- writing ----

    def _place(self, name: str, commit: Commit) -> str:
        return f"{self.table(name)}/seq={commit.seq}/attempt={commit.attempt}"

    def _write(self, df: DataFrame, name: str, commit: Commit) -> None:
        df.write.mode("overwrite").parquet(self._place(name, commit))

    def process(self, lines: DataFrame, epoch: int) -> None:
        """One micro-batch of JSON text."""
        spark, log = lines.sparkSession, self.log
        if epoch <= log.last_epoch(spark, self.run):
            self.fold(spark)  # may be what broke off
            return
        commit = Commit(log.head(spark) + 1, self.run, epoch, uuid.uuid4().hex)
        typed = lines.select("value", F.from_json("value", POS_EVENT).alias("_e")).select("value", "_e.*")
        typed = typed.withColumn("event_ts", F.col("timestamp").try_cast("timestamp"))
        typed = typed.withColumn("_good", _acceptable()).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if self._write_batch(typed, commit):
                log.append(spark, commit)
        finally:
            typed.unpersist()
        self.fold(spark)

    def _write_batch(self, typed: DataFrame, commit: Commit) -> bool:
        """Write all tables of a batch; whether there was anything to write."""
        spark, good = typed.sparkSession, typed.filter("_good")
        units = F.sum(F.when(F.col("_good"), F.col("quantity")))
        lines, accepted, sold = typed.agg(F.count(F.lit(1)), F.count_if("_good"), F.coalesce(units, F.lit(0))).first()
        if lines == 0:
            return False
        if self.gate and lines >= self.gate.lines and lines - accepted > self.gate.rejected * lines:
            self._write(typed.select("value"), "quarantine", commit)
            self._measure(spark, commit, lines, accepted, 0, sold, False)
            return True
        if accepted < lines:
            self._write(typed.filter("NOT _good").select("value"), "rejects", commit)
        staged = 0
        if accepted:
            self._write(self._unseen(spark, good, commit), "staged", commit)
            rows = spark.read.schema(POS_STAGED).parquet(self._place("staged", commit))
            tables = pos.normalize(rows)
            self._write(tables["orders"], "orders", commit)
            self._write(tables["order_items"], "order_items", commit)
            self._write(pos.consumption(tables["order_items"]), "stock_moves", commit)
            spikes = good.groupBy("branch_id").agg(F.sum("quantity").alias("units"))
            self._write(spikes.filter(F.col("units") >= self.spike_units), "spikes", commit)
            staged = rows.count()
        self._measure(spark, commit, lines, accepted, staged, sold, True)
        return True

    def _measure(self, spark: SparkSession, commit: Commit, *measures: object) -> None:
        columns = [F.lit(m).cast(f.dataType).alias(f.name) for m, f in zip(measures, _schema("batches").fields, strict=True)]
        self._write(spark.range(1, numPartitions=1).select(*columns), "batches", commit)

    def _unseen(self, spark: SparkSession, events: DataFrame, commit: Commit) -> DataFrame:
        """One row per transaction id that no batch before has staged."""
        unique = pos.stage(events.drop("value", "event_ts", "_good"))
        unique = unique.withColumn("event_ts", F.col("event_ts").cast("timestamp"))
        known = self.ids(spark).known(unique.select("transaction_id"), commit.seq - 1)
        return unique.join(known, "transaction_id", "left_anti")

    def fold(self, spark: SparkSession) -> None:
        """Fold what is due of the id index, the stock moves and the commit records."""
        head = self.log.head(spark)
        if head >= self.fan:
            self.ids(spark).fold(head)
            self._folded_moves(spark).fold(head)
            self.log.fold(spark)


def start_ingest(
    lines: DataFrame, target: Ingest, checkpoint: str, interval: str | None = "5 seconds"
) -> StreamingQuery:
    """Run the ingest; ``interval=None`` works off what is there and stops."""
    target.prepare(lines.sparkSession)
    known: list[Ingest] = []

    def process(batch: DataFrame, epoch: int) -> None:
        if not known:
            known.append(target.of_stream(batch.sparkSession, checkpoint))
        known[0].process(batch, epoch)

    writer = lines.writeStream.outputMode("append").foreachBatch(process).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def current_stock(opening: DataFrame, moves: DataFrame) -> DataFrame:
    """Opening stock less everything the stream has taken. Moves of keys without an
    opening row change nothing, as in an UPDATE; ``unmatched_moves`` lists them."""
    keys = ["branch_id", "product_id"]
    taken = moves.groupBy(*keys).agg(F.sum("total_qty").alias("total_qty"))
    left = (F.col("stock_level") - F.col("total_qty")).cast("long")
    return update_from(opening, taken, keys, {"stock_level": left})


def unmatched_moves(opening: DataFrame, moves: DataFrame) -> DataFrame:
    """What the stream took of keys that have no opening row."""
    keys = ["branch_id", "product_id"]
    taken = moves.groupBy(*keys).agg(F.sum("total_qty").alias("total_qty"))
    return taken.join(opening.select(*keys), keys, "left_anti")
