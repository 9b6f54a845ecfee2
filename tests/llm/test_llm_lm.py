import math
from collections import Counter

import pytest

from tillhouse.llm import lm
from tillhouse.llm.queries import queries


def by_hand(texts, order):
    words = [(t or "").encode().lower().split() for t in texts]
    total = sum(map(len, words))

    def grams(w, n):
        return Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1))

    corpus = [sum((grams(w, n) for w in words), Counter()) for n in range(1, order + 1)]
    out = []
    for w in words:
        own = [grams(w, n) for n in range(1, order + 1)]
        count = lambda g: corpus[len(g) - 1][g] - own[len(g) - 1][g]  # noqa: B023, E731
        score, backed = 0.0, 0
        for i in range(len(w)):
            n = full = min(i + 1, order)
            while n > 1 and count(tuple(w[i - n + 1 : i + 1])) <= 0:
                n -= 1
            value = 0.4 ** (full - n)
            if n > 1:
                value *= count(tuple(w[i - n + 1 : i + 1])) / count(tuple(w[i - n + 1 : i]))
            else:
                value *= (count((w[i],)) or 0.4) / max(total - len(w), 1)
            score += math.log(value)
            backed += n < full
        out.append((len(w), backed, score))
    return out


@pytest.mark.parametrize("order, scores", [(1, lm.lm_scores), (2, lm.lm_scores), (3, lm.lm_scores), (3, lm.relational_scores)])
def test_scores_of_messy_documents(spark, messy, rows, order, scores, monkeypatch):
    monkeypatch.setattr(lm, "BATCH_BYTES", 50_000)
    monkeypatch.setattr(lm, "SLICE_WORDS", 5_000)
    docs = spark.read.parquet(f"{messy}/documents.parquet")
    got = sorted(((r["doc_id"], r["n_words"], r["n_backed_off"], r["log_score"], r["mean_log_score"]) for r in scores(docs, order=order).collect()), key=str)
    hand = by_hand([r["text"] for r in rows], order)
    expected = sorted(((r["doc_id"], *h, h[2] / h[0] if h[0] else None) for r, h in zip(rows, hand, strict=True)), key=str)
    assert len(got) == len(expected)
    assert Counter(g[:3] for g in got) == Counter(e[:3] for e in expected)
    for n in (3, 4):
        ours, theirs = (sorted((x[:3] + (x[n],) for x in t), key=lambda x: tuple((y is None, y or 0) for y in x)) for t in (got, expected))
        assert [x[3] is None for x in ours] == [x[3] is None for x in theirs]
        assert [x[3] or 0 for x in ours] == pytest.approx([x[3] or 0 for x in theirs], rel=1e-9)


def test_query_and_empty_table(spark, messy, empty):
    assert queries()["op5_lm_scores"](spark, messy).count() == spark.read.parquet(f"{messy}/documents.parquet").count()
    assert queries()["op5_lm_scores"](spark, empty).count() == 0


def test_query_counts_trigrams(spark, tmp_path):
    texts = ["red cat sat down here", "the red cat sat up", "cat sat red cat", "sat red red cat"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in queries()["op5_lm_scores"](spark, str(tmp_path)).collect()}
    for k, (n, backed, value) in enumerate(by_hand(texts, 3)):
        assert (got[k]["n_words"], got[k]["n_backed_off"]) == (n, backed)
        assert got[k]["log_score"] == pytest.approx(value, rel=1e-9)


def test_integers_survive_packing():
    for kind in ("<u4", "<u8"):
        values = lm.np.array([0, 1, 255, 256, lm.np.iinfo(kind).max], dtype=kind)
        assert lm._unpacked(lm._packed(values), kind).tolist() == values.tolist()
    hashes = lm.np.array([3, 2**63, 2**64 - 1], dtype="<u8")
    assert lm.np.cumsum(lm._steps(hashes), dtype=lm.np.uint64).tolist() == hashes.tolist()


@pytest.mark.parametrize("scores", [lm.lm_scores, lm.relational_scores])
def test_a_table_without_words(spark, scores):
    df = spark.createDataFrame([(1, None), (2, ""), (2, " ")], "doc_id long, text string")
    assert sorted(tuple(r) for r in scores(df).collect()) == [(1, 0, 0, 0.0, None), (2, 0, 0, 0.0, None), (2, 0, 0, 0.0, None)]
