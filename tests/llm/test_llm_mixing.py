import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tillhouse.llm import mixing
from tillhouse.llm.queries import queries

NAME = "op3_source_mixing"


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets_by_hand(sizes):
    """sizes: by source. Share by weight, cut what is above, share the excess, again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    open_, target, pot = set(order), dict.fromkeys(order, 0.0), 1.5 * sum(sizes.values())
    while open_ and pot > 1e-9:
        level = pot / sum(weight[s] for s in open_)
        full = {s for s in open_ if target[s] + level * weight[s] >= 2 * sizes[s]}
        if not full:
            for s in open_:
                target[s] += level * weight[s]
            break
        for s in full:
            target[s] = 2.0 * sizes[s]
        pot = 1.5 * sum(sizes.values()) - sum(2.0 * sizes[s] for s in set(order) - open_ | full)
        open_ -= full
        for s in open_:
            target[s] = 0.0
    return target


def test_targets_and_takes_of_messy_documents(spark, messy, rows):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r["source"]] += size(r["text"])
    target = targets_by_hand(sizes)
    source = {}
    for r in rows:
        source.setdefault((r["doc_id"], size(r["text"])), []).append(r["source"])
    found = queries()[NAME](spark, messy).collect()
    assert Counter((r["doc_id"], r["size"]) for r in found) == Counter((r["doc_id"], size(r["text"])) for r in rows)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in found)
    known = {round(t, 6) for t in target.values()}
    assert {round(r["target"], 6) for r in found} <= known
    taken, wanted = defaultdict(int), {}
    for r in found:
        s = {x for x in source[r["doc_id"], r["size"]] if abs(target[x] - r["target"]) < 1e-6 and sizes[x] == r["source_size"]}
        assert s
        key = (r["source_size"], round(r["target"], 6))
        taken[key] += r["taken"]
        wanted[key] = sum(round(t) for x, t in target.items() if (sizes[x], round(t, 6)) == key)
    assert all(abs(taken[k] - wanted[k]) <= 1 for k in taken)


def test_reruns_agree(spark, messy):
    rows = [sorted(queries()[NAME](spark, messy).collect(), key=str) for _ in range(2)]
    assert rows[0] == rows[1]


def test_empty_table_and_no_words(spark, empty):
    assert queries()[NAME](spark, empty).count() == 0
    df = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [(r["target"], r["taken"]) for r in mixing.mix_rows(df).collect()] == [(0.0, 0)] * 2


def test_documents_of_the_mix(spark, messy, rows):
    docs = spark.read.parquet(f"{messy}/documents.parquet")
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    got = mixed.select("doc_id", "text", "n_chars").collect()
    taken = Counter()
    for r in got:
        taken[r["doc_id"]] += size(r["text"])
        assert r["n_chars"] == len(r["text"])
    expected = Counter()
    for r in queries()[NAME](spark, messy).collect():
        if r["taken"]:
            expected[r["doc_id"]] += r["taken"]
    assert taken == expected
    texts = defaultdict(list)
    for r in rows:
        texts[r["doc_id"]].append(r["text"] or "")
    assert all(any(t.startswith(r["text"]) for t in texts[r["doc_id"]]) for r in got)


def test_tree_splits_quotas_exactly(spark):
    mix = mixing.Mix(shards=8)
    quotas = [100, 0, 37, 1]
    leaves = mixing.split_quotas(spark.createDataFrame([(quotas,)], "quotas array<long>"), mix).collect()
    assert sorted(r["shard"] for r in leaves) == list(range(8))
    assert [sum(r["quotas"][k] for r in leaves) for k in range(4)] == quotas
    assert {sum(r["quotas"]) for r in leaves} <= {17, 18}


@pytest.mark.parametrize("total,good,draws", [(20, 7, 9), (10, 10, 4), (30, 3, 28), (5, 0, 2)])
def test_hypergeometric_follows_its_distribution(spark, total, good, draws):
    from math import comb

    n = 4000
    cols = [F.lit(x).cast("long") for x in (total, good, draws)]
    u = (F.col("id") + 0.5) / n
    got = Counter(r[0] for r in spark.range(n).select(mixing._hypergeometric(*cols, u)).collect())
    for k in range(draws + 1):
        p = comb(good, k) * comb(total - good, draws - k) / comb(total, draws)
        assert abs(got[k] / n - p) < 0.002


def test_plan_is_native(spark, messy):
    docs = spark.read.parquet(f"{messy}/documents.parquet")
    plan = mixing.mix_rows(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
