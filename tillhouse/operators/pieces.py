"""Histories of hot keys cut into pieces of about equal length, by sampled boundaries.

A key with many rows is cut in the order of its rows, wherever these lie: at boundaries
taken from a sample of its rows, so a burst in one second or a run of close values is cut
like any other. Which rows are sampled depends on a hash of their order columns, so pieces
are the same whenever Spark works them out. Keys with few rows are one piece.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a piece, about. A key with fewer is not cut.
PIECE_ROWS = 1 << 20
#: Sampled rows per piece: pieces come within a third of their length, nearly surely.
PER_PIECE = 64
#: Boundaries are looked up in two steps of so many; a key has at most their square.
STEP = 64


def _same(keys: Sequence[str], names: Sequence[str]) -> Column:
    return reduce(and_, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names, strict=True)], F.lit(True))


def boundaries(df: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int = PIECE_ROWS) -> DataFrame:
    """For each key with more than ``rows`` rows: its columns as ``_p_…`` and the sorted
    ``_bounds`` between its pieces."""
    named = [F.col(k).alias(f"_p_{k}") for k in keys]
    names = [f"_p_{k}" for k in keys]
    hot = df.groupBy(*named).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > rows)
    pieces = F.least(F.ceil(F.col("_n") / rows), F.lit(STEP * STEP))
    hot = hot.withColumn("_every", F.greatest(F.lit(1), F.floor(F.col("_n") / (pieces * PER_PIECE))))
    hot = hot.withColumn("_pieces", pieces)
    row = F.struct(*[F.col(c) for c in order])
    drawn = F.pmod(F.xxhash64(*order), F.col("_every")) == 0
    sample = df.join(hot, _same(keys, names)).filter(drawn).groupBy(*names, "_pieces").agg(F.sort_array(F.collect_list(row)).alias("_s"))
    cut = F.transform(
        F.sequence(F.lit(1), (F.col("_pieces") - 1).cast("int")),
        lambda k: F.element_at("_s", F.greatest(F.lit(1), F.floor(k * F.size("_s") / F.col("_pieces"))).cast("int")),
    )
    return sample.select(*names, F.array_distinct(cut).alias("_bounds"))


def with_pieces(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, rows: int = PIECE_ROWS) -> DataFrame:
    """Add the number of each row's piece, 0, 1, … in the ascending order of a key, NULLs
    first. Rows that are equal in ``order`` share a piece."""
    bounds = boundaries(df, keys, order, rows)
    row = F.struct(*[F.col(c) for c in order])
    steps = F.transform(
        F.sequence(F.lit(0), F.floor((F.size("_bounds") - 1) / STEP).cast("int")), lambda k: F.element_at("_bounds", k * STEP + 1)
    )
    step = F.size(F.filter(steps, lambda b: b < row)) - 1
    inside = F.size(F.filter(F.slice(F.col("_bounds"), F.greatest(F.col("_step"), F.lit(0)) * STEP + 1, STEP), lambda b: b < row))
    piece = F.when(F.col("_step") < 0, 0).otherwise(F.col("_step") * STEP + inside)
    joined = df.join(bounds, _same(keys, [f"_p_{k}" for k in keys]), "left").withColumn("_step", step)
    return joined.select(*df.columns, F.when(F.col("_bounds").isNull(), 0).otherwise(piece).cast("int").alias(name))
