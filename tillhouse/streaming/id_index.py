"""Index of all ids ever staged: buckets by hash, each with Bloom filters.

A batch asks the filters first and then reads only the buckets that may hold one of its
ids, of any age. A filter row covers one slot of a bucket, some thousand ids, in a bitmap;
filters take some ten bits an id, a good tenth of what the ids take.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks import storage
from .segments import Segment, Segments

ID = "transaction_id"
IDS = f"{ID} string"
FILTERS = "slot long, bits binary, bucket int"
#: Bits of one bitmap of `bitmap_construct_agg`.
BITMAP = 32_768
IDS_PER_SLOT = 3_000
PROBES = 5


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(ID), F.lit(buckets)).cast("int")


def _slot(slots: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("slot"), F.col(ID)), F.lit(slots)).cast("long")


def _probes() -> Column:
    """The bits of an id in the bitmap of its slot."""
    start, step = F.xxhash64(F.lit("start"), F.col(ID)), F.xxhash64(F.lit("step"), F.col(ID)).bitwiseOR(F.lit(1))
    low = F.lit(BITMAP - 1)
    return F.array(*[(start.bitwiseAND(low) + step.bitwiseAND(low) * k).bitwiseAND(low) for k in range(PROBES)])


def _is_set(bits: Column, probe: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.shiftright(probe, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    return byte.bitwiseAND(F.element_at(F.array(*[F.lit(1 << k) for k in range(8)]), (probe % 8 + 1).cast("int"))) != 0


@dataclass(frozen=True)
class IdIndex:
    """The index below ``folder``; ``staged(first, last)`` reads the ids that single
    batches staged. Segments of a higher level have more buckets, up to ``buckets``."""

    spark: SparkSession
    folder: str
    fan: int
    staged: Callable[[int, int], DataFrame]
    buckets: int = 4096

    def _buckets(self, level: int) -> int:
        return min(self.buckets, 16**level)

    def segments(self) -> Segments:
        def write(rows: DataFrame, s: Segment, path: str) -> None:
            buckets = self._buckets(s.level)
            placed = rows.select(ID).withColumn("bucket", _bucket(buckets))
            slots = max(1, -(-rows.count() // (buckets * IDS_PER_SLOT)))
            bits = placed.withColumn("slot", _slot(slots)).withColumn("probe", F.explode(_probes()))
            bits = bits.groupBy("bucket", "slot").agg(F.bitmap_construct_agg("probe").alias("bits"))
            bits = bits.repartition("bucket").write.mode("overwrite").partitionBy("bucket")
            storage.delete(self.spark, f"{path}/filters")  # of a broken attempt, with other slots
            bits.parquet(f"{path}/filters/slots={slots}")
            placed.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/ids")

        def read(_: Segment, path: str) -> DataFrame:
            return self.spark.read.schema(f"{IDS}, bucket int").parquet(f"{path}/ids").select(ID)

        return Segments(self.spark, self.folder, self.fan, self.staged, write, read)

    def buckets_to_read(self, ids: DataFrame, head: int) -> list[str]:
        """Folders of the buckets that may hold one of ``ids``; as many as there are at most."""
        segments = self.segments()
        live, _ = segments.live(head)
        found = []
        for s in live:
            path = segments.path(s)
            (slots,) = (n for n in storage.names(self.spark, f"{path}/filters") if n.startswith("slots="))
            filters = self.spark.read.schema(FILTERS).parquet(f"{path}/filters/{slots}")
            own = ids.select(ID).withColumns({"bucket": _bucket(self._buckets(s.level)), "slot": _slot(int(slots[6:]))})
            hit = own.join(filters, ["bucket", "slot"]).filter(F.forall(_probes(), lambda p: _is_set(F.col("bits"), p)))
            found.append(hit.select(F.lit(f"{path}/ids").alias("path"), "bucket").distinct())
        if not found:
            return []
        rows = found[0]
        for more in found[1:]:
            rows = rows.unionByName(more)
        return sorted(f"{r['path']}/bucket={r['bucket']}" for r in rows.collect())

    def known(self, ids: DataFrame, head: int) -> DataFrame:
        """Those of ``ids`` that batches 1 … ``head`` have staged."""
        _, single = self.segments().live(head)
        earlier = self.staged(single[0], single[-1]) if single else self.spark.createDataFrame([], IDS)
        if paths := self.buckets_to_read(ids, head):
            earlier = earlier.select(ID).unionByName(self.spark.read.schema(IDS).parquet(*paths))
        # The batch is the small side: ids of the index are read, but not shuffled.
        return earlier.join(ids.select(ID), ID, "left_semi").select(ID)

    def fold(self, head: int) -> None:
        self.segments().fold(head)
