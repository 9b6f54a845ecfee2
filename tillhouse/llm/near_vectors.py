"""Near copies among vectors: hierarchical small-world graphs per shard, audited.

Equal vectors are one point. Points are dealt by hash into shards, each a hierarchical
graph in flat arrays; every point is a query to every shard, its own one too. Two shards
meet in one task, which looks for the points of either in the graph of the other.

How wide a beam has to be is measured: a sample of the queries is compared with all
points of the shard, and the beam is doubled until it finds RECALL of their links; if
none up to WIDEST does, all queries read the whole shard. A query whose beam is full of
links is searched again with a wider one, and beyond WIDEST reads the whole shard as
well, so a crowd of near copies is never cut off.

What is found is verified in double precision. A task counts the links of its points and
reduces them to a forest, no more edges than points, so pairs never travel.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.ann import Graph, Hnsw, build, usable
from tillhouse.llm.components import least_reachable
from tillhouse.llm.shared import stored

SIMILARITY = 0.95
#: Single-precision similarities this much below the limit are still verified.
SLACK = 1e-4


@dataclass(frozen=True)
class Search:
    width: int = 32  # of the first beam
    widest: int = 512
    recall: float = 0.995  # of the links of the audited queries
    audited: int = 256  # queries, for each shard they are sent to
    shards: int = 4  # at least, but for tables of fewer than `few` points
    few: int = 2048
    shard_bytes: int = 64 << 20  # of vectors in a shard, at most about
    shard_points: int = 131_072  # at most about
    at_once: int = 256
    graph: Hnsw = Hnsw(build_width=64)


# ---- one shard ----------------------------------------------------------------------


class Shard:
    """Points of one shard: least id, a hash that tells points of one id apart, number of
    copies, vectors, graph."""

    def __init__(self, ids, hashes, copies, vectors, graph: Graph | None = None, options: Search = Search()):
        self.ids, self.hashes, self.copies = ids, hashes, copies
        # A power of two takes every vector to about one: exact, and nothing overflows.
        self.vectors = np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])
        self.norms = np.sqrt(np.einsum("nd,nd->n", self.vectors, self.vectors))
        self.units = (self.vectors / self.norms[:, None]).astype(np.float32)
        self.graph = graph or build(self.units, options.graph)
        self.graph.vectors = self.units

    @classmethod
    def read(cls, row: pd.Series) -> Shard:
        vectors = np.frombuffer(row["vectors"], "<f8").reshape(-1, row["dim"])
        points = [np.frombuffer(x["points"], "<i4") for x in row["layers"]]
        links = [np.frombuffer(x["links"], "<i4").reshape(len(p), -1) for p, x in zip(points, row["layers"], strict=True)]
        graph = Graph(vectors, points, links)
        ids, hashes, copies = (np.frombuffer(row[c], "<i8") for c in ("ids", "hashes", "copies"))
        return cls(ids, hashes, copies, vectors, graph)

    def row(self, dim: int, shard: int) -> dict:
        layers = [
            {"points": p.astype("<i4").tobytes(), "links": x.astype("<i4").tobytes()}
            for p, x in zip(self.graph.points, self.graph.links, strict=True)
        ]
        return {
            "dim": dim, "shard": shard, "ids": self.ids.astype("<i8").tobytes(), "hashes": self.hashes.astype("<i8").tobytes(),
            "copies": self.copies.astype("<i8").tobytes(), "vectors": self.vectors.astype("<f8").tobytes(), "layers": layers,
        }

    def cosines(self, at: np.ndarray, other: Shard, there: np.ndarray) -> np.ndarray:
        dots = np.einsum("nd,nd->n", self.vectors[at], other.vectors[there])
        return dots / (self.norms[at] * other.norms[there])


def links_in(queries: Shard, at: np.ndarray, shard: Shard, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, point) of the links that a beam finds, and the queries whose beam is full of them."""
    found, sims = shard.graph.search(queries.units[at], min(width, len(shard.ids)))
    good = (found >= 0) & (sims >= SIMILARITY - SLACK)
    full = good.all(axis=1) & (found.shape[1] < len(shard.ids))
    who, where = np.nonzero(good)
    who, there = at[who], found[who, where]
    sure = queries.cosines(who, shard, there) >= SIMILARITY
    return who[sure], there[sure], at[full]


def links_by_scan(queries: Shard, at: np.ndarray, shard: Shard) -> tuple[np.ndarray, np.ndarray]:
    """(query, point) of all links, by reading the whole shard."""
    who, there = np.nonzero(queries.units[at] @ shard.units.T >= SIMILARITY - SLACK)
    who = at[who]
    sure = queries.cosines(who, shard, there) >= SIMILARITY
    return who[sure], there[sure]


def audited_width(queries: Shard, shard: Shard, options: Search) -> int:
    """Width of the beam that passes the audit; beyond `widest` if none does."""
    rng = np.random.default_rng(len(queries.ids))
    sample = np.sort(rng.permutation(len(queries.ids))[: options.audited])
    who, there = links_by_scan(queries, sample, shard)
    true = set(zip(who.tolist(), there.tolist(), strict=True))
    width = options.width
    while width <= options.widest:
        who, there, full = links_in(queries, sample, shard, width)
        # A full beam is widened later anyway.
        asked = {p for p in true if p[0] not in set(full.tolist())}
        if len(asked & set(zip(who.tolist(), there.tolist(), strict=True))) >= options.recall * len(asked):
            break
        width *= 2
    return width


def found_links(queries: Shard, shard: Shard, options: Search) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, point) of the links found, and for each query whether it must read the whole shard instead."""
    width, n = audited_width(queries, shard, options), len(queries.ids)
    who, there, todo = [], [], np.arange(n)
    while width <= options.widest and len(todo):
        again = []
        for lo in range(0, len(todo), options.at_once):
            a, b, full = links_in(queries, todo[lo : lo + options.at_once], shard, width)
            done = ~np.isin(a, full)
            who.append(a[done])
            there.append(b[done])
            again.append(full)
        todo, width = np.concatenate(again), 2 * width
    scans = np.zeros(n, dtype=bool)
    scans[todo] = True
    nothing = np.zeros(0, np.int64)
    return np.concatenate([nothing, *who]).astype(np.int64), np.concatenate([nothing, *there]).astype(np.int64), scans


def merge(labels: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Labels (the least member of each class) after joining u and v."""
    while True:
        a, b = labels[u], labels[v]
        apart = a != b
        if not apart.any():
            return labels
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while True:
            further = labels[labels]
            if (further == labels).all():
                break
            labels = further


def meet(a: Shard, b: Shard, options: Search) -> pd.DataFrame:
    """Links between two shards, or within one if both are the same: rows (u, h, null, n)
    count the links of point u, copies of the other counted; rows (u, null, v, null) are
    a forest with the same components as the links."""
    own = a is b
    shift = 0 if own else len(a.ids)
    sides = [(a, 0, b, shift)] if own else [(a, 0, b, shift), (b, shift, a, 0)]
    total = shift + len(b.ids)
    ids, hashes, copies = a.ids, a.hashes, a.copies
    if not own:
        ids, hashes, copies = np.r_[ids, b.ids], np.r_[hashes, b.hashes], np.r_[copies, b.copies]
    labels, counts, scans = np.arange(total), np.zeros(total, np.int64), np.zeros(total, bool)
    pairs = []  # those of two points of which one does not read a whole shard

    def keep(u: np.ndarray, v: np.ndarray) -> None:
        u, v = np.minimum(u, v), np.maximum(u, v)
        pairs.append((u * total + v)[u != v])

    for queries, at, shard, there in sides:
        u, v, scan = found_links(queries, shard, options)
        keep(u + at, v + there)
        scans[at : at + len(queries.ids)] = scan
    for queries, at, shard, there in sides:
        todo = np.flatnonzero(scans[at : at + len(queries.ids)])
        for lo in range(0, len(todo), options.at_once):
            u, v = links_by_scan(queries, todo[lo : lo + options.at_once], shard)
            u, v = u + at, v + there
            both = scans[v]
            keep(u[~both], v[~both])
            u, v = u[both & (u != v)], v[both & (u != v)]
            np.add.at(counts, u, copies[v])  # the other point finds this one as well
            labels = merge(labels, u, v)
    unique = np.unique(np.concatenate([np.zeros(0, np.int64), *pairs]))
    u, v = unique // total, unique % total
    np.add.at(counts, u, copies[v])
    np.add.at(counts, v, copies[u])
    labels = merge(labels, u, v)
    linked, child = np.flatnonzero(counts), np.flatnonzero(labels != np.arange(total))
    counted = pd.DataFrame({"u": ids[linked], "h": hashes[linked], "v": pd.NA, "n": counts[linked]}, dtype="Int64")
    forest = pd.DataFrame({"u": ids[child], "h": pd.NA, "v": ids[labels[child]], "n": pd.NA}, dtype="Int64")
    return pd.concat([counted, forest], ignore_index=True)


# ---- on Spark -------------------------------------------------------------------------


def _spread(df: DataFrame, groups: int, *keys: str) -> DataFrame:
    """`groups` groups, few rows and much work each, over tasks of their own: adaptive
    planning would put them together by their size."""
    return df.repartition(max(1, min(4 * groups, 20_000)), *keys)


SHARD = "dim int, shard int, ids binary, hashes binary, copies binary, vectors binary, layers array<struct<points:binary,links:binary>>"


def build_shards(points: DataFrame, options: Search = Search()) -> DataFrame:
    """A row per shard of `points` (dim, h, v, first, copies)."""
    n = F.col("n")
    most = F.least(F.lit(options.shard_points), F.greatest(F.lit(1), F.lit(options.shard_bytes) / (8 * F.col("dim"))))
    shards = F.greatest(F.ceil(n / most), F.when(n < options.few, 1).otherwise(options.shards))
    sizes = points.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).select("dim", shards.cast("int").alias("shards"))
    number = sizes.agg(F.coalesce(F.sum("shards"), F.lit(0))).first()[0]
    dealt = points.join(sizes, "dim").withColumn("shard", F.pmod("h", F.col("shards")).cast("int"))

    def make(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("first")
        shard = Shard(
            *(pdf[c].to_numpy(np.int64) for c in ("first", "h", "copies")),
            np.stack(pdf["v"].to_list()).astype(np.float64), options=options,
        )
        return pd.DataFrame([shard.row(int(pdf["dim"].iloc[0]), int(pdf["shard"].iloc[0]))])

    dealt = _spread(dealt.select("dim", "shard", "h", "v", "first", "copies"), number, "dim", "shard")
    return dealt.groupBy("dim", "shard").applyInPandas(make, SHARD)


def shard_links(shards: DataFrame, options: Search = Search()) -> DataFrame:
    """(u, h, v, n) of all meetings of two shards of one dimension; see `meet`."""
    others = shards.groupBy("dim").agg(F.max("shard").alias("most"))
    other = F.explode(F.sequence(F.lit(0), F.col("most")))
    sent = shards.join(others, "dim").withColumn("other", other).drop("most")
    sent = sent.withColumns({"lo": F.least("shard", "other"), "hi": F.greatest("shard", "other")})
    meetings = others.agg(F.coalesce(F.sum((F.col("most") + 1) * (F.col("most") + 2) / 2), F.lit(0))).first()[0]
    sent = _spread(sent, int(meetings), "dim", "lo", "hi")

    def look(pdf: pd.DataFrame) -> pd.DataFrame:
        read = [Shard.read(row) for _, row in pdf.sort_values("shard").iterrows()]
        # A shard number no vector is dealt to has no row; what would meet it stays alone.
        if len(read) == 1 and pdf["lo"].iloc[0] != pdf["hi"].iloc[0]:
            return pd.DataFrame({c: pd.array([], dtype="Int64") for c in ("u", "h", "v", "n")})
        return meet(read[0], read[-1], options)

    return sent.groupBy("dim", "lo", "hi").applyInPandas(look, "u long, h long, v long, n long")


def near_vectors(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", options: Search = Search()
) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row.

    Vectors that are null, empty, zero or hold null or non-finite components, and rows
    without an id, link with nothing: n_links 0, a component of their own, kept. Vectors
    of different lengths are not compared. Equal vectors link; a repeated row is the same
    vector and no link. Several vectors of one id link as they do, and are in one
    component. Other columns are not looked at.
    """
    normal = F.transform(F.col(vector_col).cast("array<double>"), lambda x: x + F.lit(0.0))  # no -0.0
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), normal.alias("v"))
    fine = F.col("vec_id").isNotNull() & usable(F.col("v"))
    rows = rows.withColumn("v", F.when(fine, F.col("v"))).withColumn("h", F.xxhash64("v"))
    rows = stored(rows, "vectors")
    some = rows.filter("v is not null")
    named = some.distinct()
    points = named.groupBy("h", "v").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    points = stored(points.withColumn("dim", F.size("v")), "points")
    shards = stored(build_shards(points, options), "shards")
    links = stored(shard_links(shards, options), "links")
    counts = links.filter("n is not null").groupBy(F.col("u").alias("first"), "h").agg(F.sum("n").alias("n"))
    several = some.select("vec_id", "h").distinct().groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    several = named.join(several.select("vec_id"), "vec_id").join(points, ["h", "v"])
    edges = links.filter("v is not null").select("u", "v").unionByName(
        several.select(F.col("vec_id").alias("u"), F.col("first").alias("v"))
    )
    roots = least_reachable(edges)
    known = points.join(counts, ["first", "h"], "left").join(roots.withColumnRenamed("node", "first"), "first", "left")
    known = known.select(
        "h", "v", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("root", "first").alias("component_id")
    )
    linked = some.join(known, ["h", "v"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter("v is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
