"""Connected components of a graph given as edges between longs.

Alternating large-star and small-star rounds: every round is a few aggregates and
joins, no node's neighbours are gathered, and the number of rounds grows with the
logarithm of the longest path. Each round is a table in the shared folder, so that
a lost executor costs at most one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.shared import stored

MAX_ROUNDS = 200


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _with_least(edges: DataFrame) -> DataFrame:
    """Edges with the least of `u` and its neighbours `v` as `m`."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least, "u").withColumn("m", F.least("u", "m"))


def _large_star(edges: DataFrame) -> DataFrame:
    e = _with_least(_both_ways(edges))
    return e.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """`edges` have u > v."""
    e = _with_least(edges)
    turned = e.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return turned.unionByName(e.select("u", F.col("m").alias("v")))


def _state(edges: DataFrame) -> tuple:
    """Tells two sets of edges apart."""
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(h % 1000003), F.sum(h % 998244353)).first())


def least_reachable(edges: DataFrame) -> DataFrame:
    """(node, root): the least node of its component, for nodes with an edge to another.

    `edges` has longs u and v; order, repeats, loops and nulls do not matter.
    """
    edges = stored(
        edges.filter("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "edges",
    )
    state = _state(edges)
    for _ in range(MAX_ROUNDS):
        if not state[0]:
            break
        edges = stored(_small_star(_large_star(edges).distinct()).distinct(), "edges")
        before, state = state, _state(edges)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
