"""What numbered batches have written, folded into ever larger segments.

A segment of level 1 holds what ``fan`` batches wrote, one of level 2 what ``fan`` of
those hold, and so on. A reader needs fewer than ``fan`` segments of each level and
fewer than ``fan`` single batches, however many there were, and a row is written
again once per level. Which segments there should be follows from the number of the
last batch, so no list of them has to be kept.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from ..sinks import storage


MARK = "_COMPLETE"


@dataclass(frozen=True)
class Segment:
    """The batches ``first`` … ``last``."""

    level: int
    first: int
    last: int


@dataclass(frozen=True)
class Segments:
    """Segments below one folder.

    ``batches(first, last)`` reads what single batches wrote; ``write(rows, segment,
    path)`` stores a segment, and may sum rows up; ``read(segment, path)`` reads it.
    A segment is there once it has its mark. Parts of a segment go when the next one
    of its level is written, so that a reader who has just found them can end.
    """

    spark: SparkSession
    folder: str
    fan: int
    batches: Callable[[int, int], DataFrame]
    write: Callable[[DataFrame, Segment, str], None]
    read: Callable[[Segment, str], DataFrame]

    def path(self, s: Segment) -> str:
        return f"{self.folder}/level={s.level}/last={s.last}"

    def is_there(self, s: Segment) -> bool:
        return storage.exists(self.spark, f"{self.path(s)}/{MARK}")

    def planned(self, head: int) -> list[Segment]:
        """The segments that hold batches 1 … ``head``, largest first; fewer than
        ``fan`` batches are left over."""
        level = 0
        while self.fan ** (level + 1) <= head:
            level += 1
        found, start = [], 0
        for k in range(level, 0, -1):
            size = self.fan**k
            while start + size <= head:
                found.append(Segment(k, start + 1, start + size))
                start += size
        return found

    def parts(self, s: Segment) -> list[Segment]:
        size = self.fan ** (s.level - 1)
        return [Segment(s.level - 1, a, a + size - 1) for a in range(s.first, s.last + 1, size)]

    def live(self, head: int) -> tuple[list[Segment], list[int]]:
        """Segments to read, and the numbers of the batches that none of them holds.
        Where a segment is not there yet, its parts are."""
        found, single, todo = [], [], self.planned(head)
        done = todo[-1].last if todo else 0
        while todo:
            s = todo.pop(0)
            if s.level == 0:
                single.append(s.first)
            elif self.is_there(s):
                found.append(s)
            else:
                todo = self.parts(s) + todo
        return found, single + list(range(done + 1, head + 1))

    def fold(self, head: int) -> None:
        """Write the segments that batches up to ``head`` call for and that are not there."""
        for s in self.planned(head):
            self._ensure(s)

    def _ensure(self, s: Segment) -> None:
        if self.is_there(s):
            return
        if s.level == 1:
            rows = self.batches(s.first, s.last)
        else:
            for part in self.parts(s):
                self._ensure(part)
            rows = reduce(DataFrame.unionByName, (self.read(p, self.path(p)) for p in self.parts(s)))
        self.write(rows, s, self.path(s))
        storage.publish(self.spark, f"{self.path(s)}/{MARK}", "")
        size = s.last - s.first + 1
        before = Segment(s.level, s.first - size, s.last - size)
        if s.level > 1 and before.first > 0:
            for part in self.parts(before):
                storage.delete(self.spark, self.path(part))
