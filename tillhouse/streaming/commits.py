"""Commit records: what a batch wrote to several tables becomes visible at once.

A batch writes each of its tables below its own number and attempt. Its last step is a
record of both; readers join the tables with the records, so they see all of a batch or
nothing, and what a broken attempt left behind is never read.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks import storage
from .segments import Segment, Segments

COMMIT = "seq long, run string, epoch_id long, attempt string"


@dataclass(frozen=True)
class Commit:
    """Batch number ``seq`` of all runs: epoch ``epoch_id`` of a run, as one attempt wrote it."""

    seq: int
    run: str
    epoch_id: int
    attempt: str


@dataclass(frozen=True)
class CommitLog:
    """Records below ``folder``, one file each; old ones are folded into segments, so
    that reading takes few files. One stream writes at a time."""

    folder: str
    fan: int = 16

    def _file(self, seq: int) -> str:
        return f"{self.folder}/records/{seq:015d}.json"

    def _segments(self, spark: SparkSession) -> Segments:
        def write(rows: DataFrame, _: Segment, path: str) -> None:
            rows.coalesce(1).write.mode("overwrite").parquet(path)

        def read(_: Segment, path: str) -> DataFrame:
            return spark.read.schema(COMMIT).parquet(path)

        def batches(first: int, last: int) -> DataFrame:
            return self._single(spark, list(range(first, last + 1)))

        return Segments(spark, f"{self.folder}/folded", self.fan, batches, write, read)

    def _single(self, spark: SparkSession, numbers: list[int]) -> DataFrame:
        if not numbers:
            return spark.createDataFrame([], COMMIT)
        # An empty file is of a record that was never finished: no commit.
        return spark.read.schema(COMMIT).json([self._file(n) for n in numbers]).filter("attempt IS NOT NULL")

    def head(self, spark: SparkSession) -> int:
        """The highest number in use; 0 before the first batch."""
        found = storage.names(spark, f"{self.folder}/records")
        return int(found[-1].partition(".")[0]) if found else 0

    def records(self, spark: SparkSession, head: int | None = None) -> DataFrame:
        """All commits, or those up to ``head``."""
        segments = self._segments(spark)
        folded, single = segments.live(self.head(spark) if head is None else head)
        rows = self._single(spark, single)
        for s in folded:
            rows = rows.unionByName(segments.read(s, segments.path(s)))
        return rows

    def some(self, spark: SparkSession, numbers: list[int]) -> list[Commit]:
        """The commits with these numbers, of which there are few."""
        return [Commit(**r.asDict()) for r in self._single(spark, numbers).collect()]

    def last_epoch(self, spark: SparkSession, run: str) -> int:
        """The last committed epoch of a run; -1 if there is none."""
        own = self.records(spark).filter(F.col("run") == run)
        return own.agg(F.coalesce(F.max("epoch_id"), F.lit(-1))).first()[0]

    def append(self, spark: SparkSession, commit: Commit) -> None:
        """The step that makes a batch visible. An error if its number is taken."""
        storage.publish(spark, self._file(commit.seq), json.dumps(asdict(commit)) + "\n")

    def fold(self, spark: SparkSession) -> None:
        self._segments(spark).fold(self.head(spark))
