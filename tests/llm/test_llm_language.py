import zlib

import numpy as np

from tillhouse.llm import language
from tillhouse.llm.queries import queries

NAME = "op10_language_id"
FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang").collect()}
    found = queries()[NAME](spark, FOLDER).collect()
    assert len(found) == len(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in found)
    held = [r["lang_pred"] == truth[r["doc_id"]] for r in found if r["held_out"]]
    assert len(held) > 200 and sum(held) / len(held) >= 0.99


def test_messy_documents(spark, messy, rows):
    found = queries()[NAME](spark, messy).collect()
    texts = {}
    for r in rows:
        texts.setdefault(r["doc_id"], []).append(r["text"])
    assert len(found) == len(rows)
    langs = {r["lang"] for r in rows}
    for r in found:
        unknown = [not any(c.isalpha() for c in t or "") for t in texts[r["doc_id"]]]
        if all(unknown):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        elif not any(unknown):
            assert r["lang_pred"] in langs


def test_only_the_text_decides(spark, messy):
    """Names, sources and labels of a classified row play no part."""
    docs = spark.read.parquet(f"{messy}/documents.parquet")
    model = language.fit(docs.filter(~language.held_out()))
    a = language.classify(docs, model)
    b = language.classify(docs.selectExpr("doc_id", "text", "'xx' as lang", "'y' as source"), model)
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def test_empty_table_and_no_labels(spark, empty):
    assert queries()[NAME](spark, empty).count() == 0
    df = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [tuple(r)[1:3] for r in language.classify(df, language.fit(df)).collect()] == [("und", 0.0)]


def test_counts_of_a_long_text_equal_those_of_its_parts(monkeypatch):
    text = "the cat sat on the mat " * 500
    whole = language.counts(text)
    monkeypatch.setattr(language, "_AT_ONCE", 1000)
    assert np.abs(language.counts(text) - whole).sum() / whole.sum() < 0.02


def test_foreign_texts_are_rejected(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = language.fit(docs.filter(~language.held_out()))
    strange = [(k, t) for k, t in enumerate(["привет как дела сегодня хорошо", "これは日本語の文章です", "zzq xqj vvk qqz jjx"])]
    got = language.classify(spark.createDataFrame(strange, "doc_id int, text string"), model).collect()
    assert all(r["rejected"] for r in got)
    own = language.classify(docs, model).selectExpr("avg(cast(rejected as double)) x").first()["x"]
    assert own < 0.05


def test_copies_and_rows_without_letters_take_no_place_in_the_sample(spark):
    rows = [("aa", "the one text that there is so often")] * 5000 + [("aa", f"another text {k}") for k in range(40)]
    rows += [("bb", f"ein Text {k}") for k in range(500)] + [("bb", "123")] * 5000 + [("cc", "9")]
    df = spark.createDataFrame(rows, "lang string, text string")
    found = [tuple(r) for r in language.sample_of(df, per_language=100).collect()]
    assert len(set(found)) == len(found) and set(found) <= set(rows)
    number = {lang: sum(r[0] == lang for r in found) for lang in ("aa", "bb", "cc")}
    assert number == {"aa": 41, "bb": 100, "cc": 0}


def grams(text):
    """Hashed bigrams and trigrams of a text, counted one by one."""
    kept = bytearray(b" ")
    for b in text.lower().encode("utf-8", "surrogatepass") + b" ":
        b = b if 97 <= b <= 122 or b >= 128 else 32
        if b != 32 or kept[-1] != 32:
            kept.append(b)
    found = np.zeros(language.SIZE)
    for k in range(len(kept) - 1):
        found[((kept[k] << 8 | kept[k + 1] | 1 << 24) * 2654435761 & 0xFFFFFFFF) >> 20] += 1
        if k + 2 < len(kept):
            found[((kept[k] << 16 | kept[k + 1] << 8 | kept[k + 2]) * 2654435761 & 0xFFFFFFFF) >> 20] += 1
    return found


def by_hand(rows):
    """Prediction and score of every row, TF-IDF, centroids and cosines worked out plainly."""
    texts = {}
    for r in rows:
        crc = zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode())
        if crc % 3 != 1 and r["lang"] is not None and any(c.isalpha() for c in r["text"] or ""):
            texts.setdefault(r["lang"], set()).add(r["text"])
    counted = {lang: [grams(t) for t in own] for lang, own in texts.items()}
    every = [v for own in counted.values() for v in own]
    df = np.sum([v > 0 for v in every], axis=0)
    idf = np.log((1 + len(every)) / (1 + df)) + 1

    def unit(v):
        v = np.log1p(v) * idf
        return v / np.linalg.norm(v)

    centroids = []
    for lang, own in counted.items():
        own = sorted(own, key=lambda v: v.astype("<f4").tobytes())
        points = np.stack([unit(v) for v in own])
        chosen = [0]
        while len(chosen) < min(language.CLUSTERS, len(points)):
            near = [max(p @ points[c] for c in chosen) for p in points]
            if min(near) > 1 - 1e-6:
                break
            chosen.append(int(np.argmin(near)))
        means = points[chosen]
        for _ in range(language.ROUNDS):
            member = [int(np.argmax([p @ m for m in means])) for p in points]
            for k in range(len(means)):
                total = sum((p for p, m in zip(points, member, strict=True) if m == k), np.zeros(language.SIZE))
                if np.linalg.norm(total) > 0:
                    means[k] = total / np.linalg.norm(total)
        centroids += [(lang, m) for m in means]
    found = []
    for r in rows:
        if not any(c.isalpha() for c in r["text"] or ""):
            found.append((r["doc_id"], "und", 0.0))
            continue
        v = unit(grams(r["text"]))
        score, lang = max(((float(v @ m), lang) for lang, m in centroids), key=lambda x: x[0])
        found.append((r["doc_id"], lang, min(max(score, 0.0), 1.0)))
    return found


def test_predictions_equal_those_worked_out_by_hand(spark, messy, rows):
    found = sorted(((r["doc_id"], r["lang_pred"], r["score"]) for r in queries()[NAME](spark, messy).collect()), key=str)
    expected = sorted(by_hand(rows), key=str)
    assert [r[0] for r in found] == [r[0] for r in expected]
    left = list(expected)
    for doc_id, lang, score in found:
        match = next((e for e in left if e[0] == doc_id and e[1] == lang and abs(e[2] - score) < 1e-3), None)
        assert match, (doc_id, lang, score)
        left.remove(match)


def test_only_letters_make_a_language(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = language.fit(docs.filter(~language.held_out()))
    texts = ["\u00b2 \u00bd", "\u2167 \u2460 123", "_ _", "\U0001f600!", "a", "\u00aa", "\u02b0", "\u4e00"]
    got = language.classify(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), model).collect()
    assert [r.lang_pred == "und" for r in sorted(got)] == [True] * 4 + [False] * 4
