import numpy as np
import pytest

from tillhouse.llm import near_vectors
from tillhouse.llm.near_vectors import Search, Shard
from tillhouse.llm.queries import queries

NAME = "op12_embedding_near_dedup"


def by_hand(rows):
    """vec_id, n_links, component_id, kept of every (vec_id, vector)."""

    def usable(i, v):
        return i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v)

    def scaled(v):
        v = np.array(v, dtype=float)
        v = v / np.abs(v).max()
        return v / np.linalg.norm(v)

    nodes = sorted({(i, tuple(v)) for i, v in rows if usable(i, v)})
    units = [scaled(v) for _, v in nodes]
    links = {k: set() for k in range(len(nodes))}
    for a in range(len(nodes)):
        for b in range(a):
            if len(units[a]) == len(units[b]) and units[a] @ units[b] >= 0.95:
                links[a].add(b)
                links[b].add(a)
    near = {k: set(own) for k, own in links.items()}
    for k in range(1, len(nodes)):  # vectors of one id are in one component
        if nodes[k][0] == nodes[k - 1][0]:
            near[k].add(k - 1)
            near[k - 1].add(k)
    root = list(range(len(nodes)))
    for k in range(len(nodes)):
        todo = [k]
        while todo:
            for j in near[todo.pop()]:
                if root[j] > root[k]:
                    root[j] = root[k]
                    todo.append(j)
    of = {node: (len(links[k]), nodes[root[k]][0]) for k, node in enumerate(nodes)}
    found = []
    for i, v in rows:
        n, c = of[(i, tuple(v))] if usable(i, v) else (0, i)
        found.append((i, n, c, i == c))
    return sorted(found, key=str)


def result(df):
    assert df.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted(map(tuple, df.collect()), key=str)


def crowded(seed, n=400, dim=8, crowd=120, noise=0.02):
    """Random vectors, chains of near ones, and a crowd of near copies of one vector."""
    rng = np.random.default_rng(seed)
    vectors = [*rng.normal(size=(n, dim)) * rng.lognormal(0, 3, size=(n, 1))]
    for _ in range(n // 8):
        vectors.append(vectors[rng.integers(len(vectors))] * (1 + 0.12 * rng.normal(size=dim)) * rng.uniform(0.1, 10))
    centre = rng.normal(size=dim)
    vectors += [centre + noise * rng.normal(size=dim) for _ in range(crowd)]
    return [(int(i), list(map(float, v))) for i, v in zip(rng.permutation(len(vectors)), vectors, strict=True)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def test_whole_table_of_vectors_with_planted_copies(spark, tmp_path):
    real = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding").collect()
    rng = np.random.default_rng(2)
    rows = [(r[0], [float(x) for x in r[1]]) for r in real]
    for k in range(300):
        v = np.array(rows[rng.integers(len(rows))][1])
        rows.append((5000 - k, list(map(float, v + rng.normal(size=len(v)) * rng.choice([0.01, 0.02, 0.04])))))
    frame(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = result(queries()[NAME](spark, str(tmp_path)))
    assert found == by_hand(rows) and sum(r[1] for r in found) > 500


@pytest.mark.parametrize(
    "options",
    [
        Search(),
        Search(shards=3, few=1, at_once=16),
        Search(shards=3, few=1, width=4, widest=16, audited=20),  # the crowd reads whole shards
        Search(shards=2, few=1, width=64, widest=32),  # every query does
        Search(shard_points=100),
    ],
)
def test_crowds_and_chains(spark, options):
    rows = crowded(1)
    assert result(near_vectors.near_vectors(frame(spark, rows), options=options)) == by_hand(rows)


def test_messy_vectors(spark, tmp_path):
    rows = crowded(3, n=150, dim=4, crowd=20)
    v = rows[0][1]
    rows += [(1000 + k, v) for k in range(60)]  # one vector, many ids
    rows += [(1000, v), (1001, v), rows[5], (rows[6][0], rows[7][1])]  # repeated rows; an id with two vectors
    rows += [(2000, None), (2001, [0.0] * 4), (2002, [1.0, None, 0.0, 0.0]), (2003, [float("nan")] * 4), (2004, [float("inf")] * 4)]
    rows += [(2005, []), (None, v), (None, None), (2006, [1.0, 2.0]), (2007, [2.0, 4.0]), (2008, [-0.0, 1.0]), (2009, [0.0, 1.0])]
    rows += [(2010, [1e300] * 4), (2011, [1e-300] * 4), (2012, [1e300, 1e300, 1e300, 9e299])]
    schema = "vec_id long, embedding array<double>, v int, h string, first long, copies int, dim int, shard int, n long, root long"
    spark.createDataFrame([(*r, 1, "h", 2, 3, 4, 5, 6, 7) for r in rows], schema).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert result(queries()[NAME](spark, str(tmp_path))) == by_hand(rows)


def test_empty_table(spark, empty):
    assert queries()[NAME](spark, empty).count() == 0


def test_audits_widen_the_beam():
    rng = np.random.default_rng(4)
    vectors = np.concatenate([rng.normal(size=(600, 6)), 3 + 0.3 * rng.normal(size=(200, 6))])
    shard = Shard(np.arange(800), np.arange(800), np.ones(800, dtype=np.int64), vectors)
    assert near_vectors.audited_width(shard, shard, Search()) <= 128
    lost = Shard(np.arange(800), np.arange(800), np.ones(800, dtype=np.int64), vectors)
    for links in lost.graph.links:  # a graph without links finds nothing, whatever the beam
        links[:] = -1
    assert near_vectors.audited_width(lost, lost, Search()) > Search().widest
    whole = near_vectors.meet(shard, shard, Search())
    broken = near_vectors.meet(lost, lost, Search())
    counts = [dict(zip(x.loc[x["n"].notna(), "u"], x.loc[x["n"].notna(), "n"], strict=True)) for x in (whole, broken)]
    assert counts[0] == counts[1]


def test_rows_of_a_meeting_follow_the_points():
    """A crowd of near copies gives as many rows as it has members, not as it has pairs."""
    rng = np.random.default_rng(5)
    for n in (100, 1000):
        vectors = 1 + 0.01 * rng.normal(size=(n, 6))
        shard = Shard(np.arange(n), np.arange(n), np.ones(n, dtype=np.int64), vectors)
        found = near_vectors.meet(shard, shard, Search(widest=64))
        assert len(found) == 2 * n - 1 and (found["n"].dropna() == n - 1).all()
