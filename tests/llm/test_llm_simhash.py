import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from tillhouse.llm import components, simhash
from tillhouse.llm.queries import queries

NAME = "op6_simhash_near_dedup"


def by_hand(text):
    small = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", small)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(pairs, items):
    parent = {i: i for i in items}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in items}


def near(fps):
    return [(a, b) for a in fps for b in fps if a > b and (a ^ b).bit_count() <= 2]


def test_components_of_messy_documents(spark, messy, rows):
    fps = [by_hand(r["text"]) for r in rows]
    root = classes(near(set(fps)), set(fps))
    least = {}
    for r, fp in zip(rows, fps, strict=True):
        if r["doc_id"] is not None:
            least[root[fp]] = min(r["doc_id"], least.get(root[fp], r["doc_id"]))
    expected = [(r["doc_id"], f"{fp:016x}", least.get(root[fp])) for r, fp in zip(rows, fps, strict=True)]
    found = [tuple(r) for r in queries()[NAME](spark, messy).collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)


def test_empty_table(spark, empty):
    assert queries()[NAME](spark, empty).count() == 0


@pytest.mark.parametrize("crowd", [1, 3, 128])
def test_all_links_also_in_crowds(spark, crowd):
    """Fingerprints a few bits from two centres, one of them all zero in one half."""
    rng = random.Random(5)
    fps = set()
    for centre in (0xFFFFFFFF, rng.getrandbits(64)):
        for _ in range(120):
            fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))))
    signed = {x - (1 << 64) if x >> 63 else x: x for x in fps}
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    found = {frozenset((signed[r["u"]], signed[r["v"]])) for r in simhash.near_links(df, crowd).collect()}
    assert found == {frozenset(p) for p in near(fps)}


def test_components_of_chains_and_stars(spark):
    rng = random.Random(1)
    ids = rng.sample(range(-1000, 1000), 400)
    pairs = [(ids[i], ids[i + 1]) for i in range(99)]  # a long chain
    pairs += [(ids[100], ids[k]) for k in range(101, 250)]  # a star
    pairs += [(ids[k], ids[k + 1]) for k in range(260, 380, 3)] + [(ids[390], ids[390])]
    df = spark.createDataFrame(pairs, "u long, v long")
    found = {r["node"]: r["root"] for r in components.least_reachable(df).collect()}
    nodes = {x for p in pairs for x in p if p[0] != p[1]}
    assert found == {k: v for k, v in classes(pairs, ids).items() if k in nodes}


def test_first_of_each(spark, messy):
    docs = spark.read.parquet(f"{messy}/documents.parquet")
    kept = simhash.first_of_each(docs)
    assert kept.columns == docs.columns
    groups = queries()[NAME](spark, messy).select("component_id").distinct()
    rows = kept.select("doc_id").collect()
    assert len(rows) == groups.count()
    named = groups.filter("component_id is not null").collect()
    assert {r["component_id"] for r in named} <= {r["doc_id"] for r in rows}


def test_very_long_texts_are_counted_in_parts(monkeypatch):
    text = " ".join(f"w{i}" for i in range(1000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "AT_ONCE", 7)
    assert simhash.fingerprint(text) == whole == by_hand(text) - ((1 << 64) if by_hand(text) >> 63 else 0)


def test_index_is_joined_by_equality(spark):
    plan = simhash.near_links(spark.range(100).select(F.col("id").alias("fp")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text
