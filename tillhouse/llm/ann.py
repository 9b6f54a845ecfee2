"""Nearest neighbours by largest inner product, from a navigable small-world graph per shard.

Equal vectors are one point that carries its smallest ids. Points are dealt by length, to
the next power of two, and by hash into shards; each shard is a hierarchical graph, stored as one row of flat arrays.
Queries go in blocks to every shard, and the shards' best are merged by query.

For graphs, inner product becomes an angle: each point gets one more coordinate that
brings all of a shard to one length, and queries get a zero there. As no vector of a shard
is more than twice as long as another, that coordinate does not drown the others. Scores are inner
products of the original vectors in double precision.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillhouse.llm.shared import stored


@dataclass(frozen=True)
class Hnsw:
    links: int = 16  # of a point in upper layers; twice as many in the lowest
    build_width: int = 64
    search_width: int = 160
    shard_points: int = 8192  # about
    block_queries: int = 1024  # about
    seed: int = 7


# ---- one shard ----------------------------------------------------------------------


class Graph:
    """Layers of one shard: `points[l]` numbers the points of layer l, `links[l]` holds
    for each of them, in a fixed number of places, numbers of points; -1 is empty."""

    def __init__(self, vectors: np.ndarray, points: list[np.ndarray], links: list[np.ndarray]):
        self.vectors, self.points, self.links = vectors, points, links
        self.rows = []  # of a layer: row in `links` by number of point
        for own in points:
            row = np.full(len(vectors), -1, dtype=np.int32)
            row[own] = np.arange(len(own), dtype=np.int32)
            self.rows.append(row)

    def search(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers (-1: none) and similarities of the best found, best first."""
        top = len(self.points) - 1
        entries = np.full((len(queries), 1), self.points[top][0], dtype=np.int32)
        for layer in range(top, 0, -1):
            entries, _ = beam(self.vectors, self.links[layer], self.rows[layer], queries, entries, 8)
        return beam(self.vectors, self.links[0], self.rows[0], queries, entries, width)


def lifted(vectors: np.ndarray) -> np.ndarray:
    """float32 vectors with the coordinate that makes all equally long."""
    v = vectors.astype(np.float64)
    v = v / max(float(np.abs(v).max()), 1e-300)
    square = (v**2).sum(axis=1)
    return np.column_stack([v, np.sqrt(np.maximum(square.max() - square, 0))]).astype(np.float32)


def beam(vectors, links, rows, queries, entries, width, at_once: int = 4):
    """Best-first search in one layer, for all queries side by side."""
    n = len(queries)
    seen = np.zeros((n, len(vectors) + 1), dtype=bool)
    seen[:, -1] = True  # -1 is nobody
    line = np.arange(n)[:, None]
    ids = np.full((n, width), -1, dtype=np.int32)
    sims = np.full((n, width), -np.inf, dtype=np.float32)
    done = np.ones((n, width), dtype=bool)
    entries = entries[:, :width]
    k = entries.shape[1]
    ids[:, :k] = entries
    sims[:, :k] = np.where(entries >= 0, np.einsum("qkd,qd->qk", vectors[entries], queries), -np.inf)
    done[:, :k] = entries < 0
    seen[line, entries] = True
    active = np.arange(n)
    while len(active):
        a_done, a_ids = done[active], ids[active]
        rank = np.where(a_done, -np.inf, sims[active])
        pick = np.argpartition(-rank, min(at_once, width - 1), axis=1)[:, :at_once]
        good = ~np.take_along_axis(a_done, pick, axis=1)
        chosen = np.where(good, np.take_along_axis(a_ids, pick, axis=1), -1)
        np.put_along_axis(a_done, pick, True, axis=1)
        done[active] = a_done
        near = np.where(chosen[:, :, None] >= 0, links[rows[chosen]], -1).reshape(len(active), -1)
        near.sort(axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        near[seen[active[:, None], near]] = -1
        seen[active[:, None], near] = True
        value = np.where(near >= 0, np.einsum("qkd,qd->qk", vectors[near], queries[active]), -np.inf)
        all_ids = np.concatenate([a_ids, near], axis=1)
        all_sims = np.concatenate([sims[active], value.astype(np.float32)], axis=1)
        all_done = np.concatenate([a_done, near < 0], axis=1)
        keep = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
        ids[active] = np.take_along_axis(all_ids, keep, axis=1)
        sims[active] = np.take_along_axis(all_sims, keep, axis=1)
        done[active] = np.take_along_axis(all_done, keep, axis=1)
        active = active[~done[active].all(axis=1)]
    order = np.argsort(-sims, axis=1, kind="stable")
    ids, sims = np.take_along_axis(ids, order, axis=1), np.take_along_axis(sims, order, axis=1)
    return np.where(np.isfinite(sims), ids, -1), sims


def spread_out(vectors, bases, candidates, most):
    """Of each base's candidates (best first, -1: none): those nearer to it than to one
    taken before; places left over go to the best of the others."""
    sims = np.einsum("bcd,bd->bc", vectors[candidates], vectors[bases])
    sims = np.where(candidates >= 0, sims, -np.inf)
    order = np.argsort(-sims, axis=1, kind="stable")
    candidates, sims = np.take_along_axis(candidates, order, axis=1), np.take_along_axis(sims, order, axis=1)
    own = vectors[candidates]
    among = own @ own.transpose(0, 2, 1)
    valid = candidates >= 0
    taken = np.zeros(candidates.shape, dtype=bool)
    for j in range(candidates.shape[1]):
        hidden = (taken & (among[:, j, :] >= sims[:, j, None])).any(axis=1)
        taken[:, j] = valid[:, j] & ~hidden & (taken.sum(axis=1) < most)
    rank = np.where(taken, 0, np.where(valid, 1, 2))
    first = np.argsort(rank, axis=1, kind="stable")[:, :most]
    chosen = np.take_along_axis(candidates, first, axis=1)
    if chosen.shape[1] < most:
        chosen = np.pad(chosen, ((0, 0), (0, most - chosen.shape[1])), constant_values=-1)
    return chosen


def _link_back(vectors, links, rows, new, chosen, most, at_once=1024):
    """Give those chosen by `new` points a link to them."""
    targets, sources = chosen.ravel(), np.repeat(new, chosen.shape[1])
    sources, targets = sources[targets >= 0], targets[targets >= 0]
    value = np.einsum("ed,ed->e", vectors[sources], vectors[targets])
    order = np.lexsort((sources, -value, targets))
    sources, targets = sources[order], targets[order]
    starts = np.flatnonzero(np.r_[True, targets[1:] != targets[:-1]])
    place = np.arange(len(targets)) - np.repeat(starts, np.diff(np.r_[starts, len(targets)]))
    sources, at, place = sources[place < most], targets[place < most], place[place < most]
    hit = targets[starts]
    row = np.full(len(vectors), -1, dtype=np.int64)
    row[hit] = np.arange(len(hit))
    more = np.full((len(hit), most), -1, dtype=np.int32)
    more[row[at], place] = sources
    for lo in range(0, len(hit), at_once):
        part = hit[lo : lo + at_once]
        both = np.concatenate([links[rows[part]], more[lo : lo + at_once]], axis=1)
        links[rows[part]] = spread_out(vectors, part, both, most)


def build(vectors: np.ndarray, options: Hnsw = Hnsw()) -> Graph:
    """Graph of distinct `vectors` (already lifted): layers from the top down, points in
    batches that grow with what stands, those of the layer above first."""
    n = len(vectors)
    rng = np.random.default_rng(options.seed)
    level = np.floor(-np.log(rng.random(n)) / np.log(options.links)).astype(int)
    level[0] = max(level.max(), 0)
    order = np.lexsort((rng.permutation(n), -level)).astype(np.int32)
    points: list[np.ndarray] = []
    links: list[np.ndarray] = []
    upper: Graph | None = None
    for layer in range(int(level.max()), -1, -1):
        own = order[: int((level >= layer).sum())]
        most = options.links * (1 if layer else 2)
        graph_links = np.full((len(own), most), -1, dtype=np.int32)
        rows = np.full(n, -1, dtype=np.int32)
        rows[own] = np.arange(len(own), dtype=np.int32)
        stands = min(len(own), 2 * most)  # the first ones know each other
        first = own[:stands]
        others = np.tile(first, (stands, 1))
        others[np.arange(stands), np.arange(stands)] = -1
        graph_links[:stands] = spread_out(vectors, first, others, most)
        while stands < len(own):
            new = own[stands : stands + min(512, stands)]
            if upper is None:
                entries = np.full((len(new), 1), own[0], dtype=np.int32)
            else:
                entries, _ = upper.search(vectors[new], 8)
            found, _ = beam(vectors, graph_links, rows, vectors[new], entries, options.build_width)
            found = np.where(found == new[:, None], -1, found)  # points of the layer above are found, too
            chosen = spread_out(vectors, new, found, most)
            graph_links[rows[new]] = chosen
            _link_back(vectors, graph_links, rows, new, chosen, most)
            stands += len(new)
        points.insert(0, own)
        links.insert(0, graph_links)
        upper = Graph(vectors, list(points), list(links))
    return Graph(vectors, points, links)


# ---- on Spark -------------------------------------------------------------------------


def usable(vector: Column) -> Column:
    """Not null or empty, not zero, no null or non-finite component."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def _vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    return rows.filter(F.col("vec_id").isNotNull() & usable(F.col("v")))


INDEX = "dim int, shard int, ids binary, ends binary, vectors binary, layers array<struct<points:binary,links:binary>>"


def build_index(
    table: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding", options: Hnsw = Hnsw()
) -> DataFrame:
    """One row per shard, for searches of up to k neighbours.

    A vector that several rows share keeps its k + 1 smallest ids: a search for k needs
    no more of them. Vectors with different numbers of components, and those of very
    different length, are in different shards.
    """
    rows = _vectors(table, id_col, vector_col).distinct()
    nth = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    points = rows.withColumn("nth", nth).filter(F.col("nth") <= k + 1)
    points = points.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    points = stored(points.withColumn("dim", F.size("v")), "points")
    # Octaves of the length, with a border away from one, where many tables have theirs.
    most = F.array_max(F.transform("v", lambda x: F.abs(x)))
    square = F.aggregate("v", F.lit(0.0), lambda total, x: total + (x / most) * (x / most))
    points = points.withColumn("band", F.floor(F.log2(most) + F.log2(square) / 2 + 0.5).cast("int"))
    bands = points.groupBy("dim", "band").agg(F.ceil(F.count(F.lit(1)) / options.shard_points).cast("int").alias("shards"))
    in_line = Window.partitionBy("dim").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    bands = bands.withColumn("first_shard", F.coalesce(F.sum("shards").over(in_line), F.lit(0)).cast("int"))
    points = points.join(bands, ["dim", "band"])
    shard = F.col("first_shard") + F.pmod(F.xxhash64("v"), F.col("shards")).cast("int")

    def make(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(first=[ids[0] for ids in pdf["ids"]]).sort_values("first")
        original = np.stack(pdf["v"].to_list()).astype("<f8")
        graph = build(lifted(original), options)
        ends = np.cumsum([len(x) for x in pdf["ids"]])
        layers = [
            {"points": p.astype("<i4").tobytes(), "links": x.astype("<i4").tobytes()}
            for p, x in zip(graph.points, graph.links, strict=True)
        ]
        row = {
            "dim": int(pdf["dim"].iloc[0]),
            "shard": int(pdf["shard"].iloc[0]),
            "ids": np.concatenate(pdf["ids"].to_list()).astype("<i8").tobytes(),
            "ends": ends.astype("<i8").tobytes(),
            "vectors": original.tobytes(),
            "layers": layers,
        }
        return pd.DataFrame([row])

    points = points.withColumn("shard", shard).select("dim", "shard", "v", "ids")
    return points.groupBy("dim", "shard").applyInPandas(make, INDEX)


def _open(row: pd.Series) -> tuple[Graph, np.ndarray, np.ndarray, np.ndarray]:
    vectors = np.frombuffer(row["vectors"], dtype="<f8").reshape(-1, row["dim"])
    points = [np.frombuffer(x["points"], dtype="<i4") for x in row["layers"]]
    links = [np.frombuffer(x["links"], dtype="<i4").reshape(len(p), -1) for p, x in zip(points, row["layers"], strict=True)]
    ids, ends = np.frombuffer(row["ids"], dtype="<i8"), np.frombuffer(row["ends"], dtype="<i8")
    return Graph(lifted(vectors), points, links), vectors, ids, ends


def search(
    index: DataFrame,
    queries: DataFrame,
    k: int,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    options: Hnsw = Hnsw(),
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best found for each query, its own id excluded.

    Queries whose vector is null, zero or has a null or non-finite component, or whose
    id is null, give no rows, nor does an empty index. Of several vectors of one query
    id the least counts. Ties go to the smaller vec_id.
    """
    asked = _vectors(queries, id_col, vector_col).groupBy("vec_id").agg(F.min("v").alias("v"))
    asked = stored(asked.withColumn("dim", F.size("v")), "queries")
    blocks = max(1, -(-asked.count() // options.block_queries))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    # Every query meets every shard of its length, a block of them at a time.
    shards = index.select("dim", "shard").distinct()
    left = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = asked.join(shards.groupBy("dim").agg(F.collect_list("shard").alias("shards")), "dim")
    right = right.select("dim", "block", "vec_id", "v", F.explode("shards").alias("shard"))
    width = max(options.search_width, 2 * (k + 1))

    def look(shard: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
        if not len(shard) or not len(part):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        graph, vectors, ids, ends = _open(shard.iloc[0])
        starts = np.r_[0, ends[:-1]]
        rows = []
        part = part.sort_values("vec_id")
        for lo in range(0, len(part), 256):
            some = part.iloc[lo : lo + 256]
            q = np.stack(some["v"].to_list())
            scale = np.abs(q).max(axis=1, keepdims=True)
            found, _ = graph.search(np.column_stack([q / scale, np.zeros(len(q))]).astype(np.float32), width)
            for query_id, vector, near in zip(some["vec_id"], q, found, strict=True):
                near = near[near >= 0]
                scores = np.array([float(np.dot(vectors[x], vector)) for x in near])
                best = []
                for x in np.argsort(-scores, kind="stable"):
                    if len(best) >= k and scores[x] < best[k - 1][0]:
                        break
                    own = ids[starts[near[x]] : ends[near[x]]]
                    best += [(scores[x], i) for i in own if i != query_id]
                best.sort(key=lambda b: (-b[0], b[1]))
                rows += [(query_id, i, s) for s, i in best[:k]]
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"])

    found = (
        left.groupBy("dim", "shard", "block")
        .cogroup(right.groupBy("dim", "shard", "block"))
        .applyInPandas(look, "query_id long, vec_id long, score double")
    )
    # A row of several vectors may be found by more than one of them.
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
