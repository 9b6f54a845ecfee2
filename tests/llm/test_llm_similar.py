import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tillhouse.llm import components, similar


def sets_of(rows):
    return [frozenset(similar._grams(similar._words(r["text"]), 5)) for r in rows]


def by_hand(rows):
    """Least doc_id of each row's class, and the pairs of different texts that are similar."""
    sets, parent, pairs = sets_of(rows), list(range(len(rows))), []

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            size = len(sets[a] | sets[b])
            if size == 0 or len(sets[a] & sets[b]) / size >= similar.SIMILARITY:
                pairs.append((a, b))
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    least = {}
    for k, r in enumerate(rows):
        if r["doc_id"] is not None:
            least[find(k)] = min(r["doc_id"], least.get(find(k), r["doc_id"]))
    return [least.get(find(k)) for k in range(len(rows))]


def test_classes_of_messy_documents(spark, messy, rows):
    found = similar.near_copy_classes(spark.read.parquet(f"{messy}/documents.parquet")).collect()
    expected = [(r["doc_id"], c) for r, c in zip(rows, by_hand(rows), strict=True)]
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)


def edited(rng, words, share):
    return [rng.choice("abcdefgh") * 4 if rng.random() < share else w for w in words]


@pytest.mark.parametrize("crowd", [3, 8, 64])
def test_near_copies_are_found_and_others_left_alone(spark, crowd):
    rng = random.Random(6)
    rows, k = [], 0
    for _ in range(12):
        words = [f"{rng.randrange(400)}w" for _ in range(rng.randint(60, 500))]
        for share in [0, 0, 0.005, 0.01, 0.02, 0.2]:
            rows.append({"doc_id": k, "text": " ".join(edited(rng, words, share))})
            k += 1
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["class_id"] for r in similar.near_copy_classes(df, crowd=crowd).collect()}
    expected = {r["doc_id"]: c for r, c in zip(rows, by_hand(rows), strict=True)}
    wrong = [i for i in found if found[i] != expected[i]]
    assert all(expected[found[i]] == expected[i] for i in found)  # nothing is joined that is not similar
    assert len(wrong) <= 2
    kept = {r["doc_id"] for r in similar.first_of_each_class(df, crowd=crowd).collect()}
    assert kept == set(found.values())


def test_crowds_are_connected_pair_by_pair_in_the_end(spark):
    """Members of a crowd that resemble each other, but not the one that all are compared with."""
    rng = random.Random(2)
    base = [f"{rng.randrange(90)}w" for _ in range(200)]
    rows, step = [], list(base)
    for k in range(40):  # a chain: each resembles the one before, the ends do not
        step = list(step)
        for at in rng.sample(range(200), 2):
            step[at] = f"x{k}"
        rows.append({"doc_id": k, "text": " ".join(step)})
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["class_id"] for r in similar.near_copy_classes(df, crowd=2).collect()}
    assert found == {r["doc_id"]: c for r, c in zip(rows, by_hand(rows), strict=True)}


def test_empty_table(spark, empty):
    assert similar.near_copy_classes(spark.read.parquet(f"{empty}/documents.parquet")).count() == 0


def test_repeated_rows_and_columns(spark, messy):
    docs = spark.read.parquet(f"{messy}/documents.parquet")
    kept = similar.first_of_each_class(docs)
    assert kept.columns == docs.columns
    assert kept.count() == similar.near_copy_classes(docs).select("class_id").distinct().count()


def test_long_texts_are_counted_in_parts(monkeypatch):
    text = " ".join(f"w{k * k % 911}" for k in range(3000))
    whole = similar.segments(text)
    monkeypatch.setattr(similar, "AT_ONCE", 10)
    assert similar.segments(text) == whole


def test_pairs_just_similar_enough_and_repeated_sentences_are_found(spark):
    rng = random.Random(11)
    word = lambda: f"{rng.randrange(3000)}w"
    texts = []
    for k in range(120):  # scattered edits down to a similarity of 0.80 to 0.82
        words = [word() for _ in range(300)]
        other, places = list(words), rng.sample(range(300), 300)
        one = frozenset(similar._grams([w.encode() for w in words], 5))
        for at in places:
            other[at] = f"x{k}"
            two = frozenset(similar._grams([w.encode() for w in other], 5))
            if len(one & two) / len(one | two) <= 0.82:
                break
        if len(one & two) / len(one | two) >= 0.8:
            texts += [" ".join(words), " ".join(other)]
    assert len(texts) >= 160
    for k in range(40):  # one sentence that the copy has many times over
        words = [word() for _ in range(1000)]
        again = " ".join(word() for _ in range(10))
        texts += [" ".join(words), " ".join(words + [again] * (10 + 10 * (k % 2)))]
    rows = [{"doc_id": k, "text": t} for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["class_id"] for r in similar.near_copy_classes(df).collect()}
    expected = {k: k - k % 2 for k in found}
    assert all(expected[found[k]] == expected[k] for k in found)  # no wrong documents
    assert sum(found[k] != expected[k] for k in found) <= 1


def test_few_rows_of_a_batch_are_python_objects_at_once(monkeypatch):
    texts = [None, "", *(f"word{k} " * (k % 40) + "and some more words of a text" for k in range(700))]
    sets = [similar.shingles(t) for t in texts]
    assert similar._segments.func(pa.array(texts)).to_pylist() == [similar.segments(t) for t in texts]
    assert similar._shingles.func(pa.array(texts)).to_pylist() == sets
    found = similar._jaccard.func(pa.array(sets), pa.array(sets[1:] + sets[:1])).to_pylist()
    assert found == [similar.jaccard(a, b) for a, b in zip(sets, sets[1:] + sets[:1], strict=True)]
    assert similar._segments.func(pa.array([], pa.string())).to_pylist() == []

    long = pa.array([f"{k:05000}" for k in range(8000)])
    monkeypatch.setattr(similar, "segments", lambda text: [len(text)])
    tracemalloc.start()
    try:
        assert similar._segments.func(long).to_pylist() == [[5000]] * 8000
        assert tracemalloc.get_traced_memory()[1] < 8_000_000
    finally:
        tracemalloc.stop()


def test_crowds_make_rows_by_their_members_not_by_their_pairs(spark, monkeypatch):
    """Near copies of one text, half of them too far from all others to be linked."""
    rng = random.Random(4)
    base = [f"{rng.randrange(400)}w" for _ in range(150)]
    texts = [" ".join(base)]
    for k in range(400):
        words = list(base)
        for at in rng.sample(range(150), rng.randint(1, 3) if k % 2 else rng.randint(6, 15)):
            words[at] = f"x{k}y{at}"
        texts.append(" ".join(words))
    rows = [{"doc_id": k, "text": t} for k, t in enumerate(texts)]
    made, real = [], similar.stored

    def counted(df, name):
        out = real(df, name)
        if name in ("pairs", "rest", "links", "edges"):
            made.append((name, out.count()))
        return out

    monkeypatch.setattr(similar, "stored", counted)
    monkeypatch.setattr(components, "stored", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["class_id"] for r in similar.near_copy_classes(df).collect()}
    assert found == {r["doc_id"]: c for r, c in zip(rows, by_hand(rows), strict=True)}
    assert 100 < len(set(found.values())) < 300
    assert max(n for _, n in made) <= 5 * len(rows), made


def test_prefix_pairs_lose_no_similar_sets(spark):
    """Sets of uneven sizes around the threshold, with shingles shared by few and by most."""
    rng = random.Random(8)
    sets = []
    for _ in range(6):
        base = rng.sample(range(1 << 20), rng.randint(5, 60))
        for _ in range(15):
            kept = [x for x in base if rng.random() < rng.choice([0.8, 0.95, 1])]
            sets.append(sorted({*kept, *rng.sample(range(1 << 20), rng.randint(0, 6))}))
    sets = [np.array(x, dtype="<u4").tobytes() for x in sets]
    roots = [rng.randrange(40) for _ in sets]
    members = spark.createDataFrame(list(zip(range(len(sets)), roots, sets)), "node long, root long, set binary")
    found = {(r["u"], r["v"]) for r in similar._prefix_pairs(members).collect()}
    similar_ones = {
        (a, b)
        for a in range(len(sets))
        for b in range(a)
        if roots[a] != roots[b] and similar.jaccard(sets[a], sets[b]) >= similar.SIMILARITY
    }
    assert similar_ones <= found and len(similar_ones) > 40
    assert all(roots[a] != roots[b] for a, b in found)
