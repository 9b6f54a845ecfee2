import re
from collections import Counter

from tillhouse.llm import quality
from tillhouse.llm.queries import queries

NAME = "op2_quality_rules"


def by_hand(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = Counter(grams)
    at = {p for i, g in enumerate(grams) if often[g] > 1 for p in range(i, i + 3)}
    n = len(w)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(at),
            n < 50 or 100 * len(at) > 50 * n)


def test_counts_of_messy_documents(spark, messy, rows):
    found = queries()[NAME](spark, messy).drop("kept").collect()
    key = lambda r: tuple((x is None, x) if x is not None else (True, 0) for x in r)
    expected = [(r["doc_id"], *by_hand(r["text"])) for r in rows]
    assert sorted(map(tuple, found), key=key) == sorted(expected, key=key)


def test_empty_table(spark, empty):
    assert queries()[NAME](spark, empty).count() == 0


def test_labelled_documents(spark):
    """Of texts that pass the fixed rules, good ones stay and bad ones go."""
    folder = "/root/testdata/sf0.01"
    found = queries()[NAME](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    found = found.filter("not base_failed").groupBy("quality", "kept").count().collect()
    assert {(r["quality"], r["kept"]) for r in found} == {(1, True), (0, False)}


def test_rules_are_a_table(spark):
    strict = (quality.Rule("words", "n_words", low=3),)
    df = spark.createDataFrame([(1, "a b c d"), (2, "a b")], "doc_id int, text string")
    got = {r["doc_id"]: r["failed"] for r in quality.quality_report(df, rules=strict).collect()}
    assert got == {1: [], 2: ["words"]}


def test_one_projection(spark, messy):
    plan = queries()[NAME](spark, messy)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_keep_good_keeps_all_columns(spark, messy):
    docs = spark.read.parquet(f"{messy}/documents.parquet")
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert kept.count() == queries()[NAME](spark, messy).filter("kept").count()
