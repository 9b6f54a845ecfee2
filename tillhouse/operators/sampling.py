"""Weighted random picks per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Bits of a draw: as many as a double keeps with the half added.
DRAW_BITS = 52


def hash_uniform(key: Column, seed: int) -> Column:
    """A number in (0, 1) that depends only on the key and the seed, so a re-run
    task draws the same number again."""
    digits = F.substring(F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed)))), 1, DRAW_BITS // 4)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(1 << DRAW_BITS))


def weighted_sample(
    df: DataFrame, weight: str, k: int, by: Sequence[str], key: str, seed: int = 0, name: str = "pick_rank"
) -> DataFrame:
    """``k`` rows per group, drawn without replacement in proportion to weight.

    Exponential race: the smallest -ln(u) / weight wins. The rank filter is
    applied in every task before the shuffle, so a group of any size sends at
    most k rows per task. Rows with no positive weight cannot be drawn.
    """
    arrival = -F.log(hash_uniform(F.col(key), seed)) / F.col(weight).cast("double")
    race = Window.partitionBy(*by).orderBy("_arrival", key)
    return (
        df.filter(F.col(weight) > 0)
        .withColumn("_arrival", arrival)
        .withColumn(name, F.row_number().over(race))
        .filter(F.col(name) <= k)
        .drop("_arrival")
    )
