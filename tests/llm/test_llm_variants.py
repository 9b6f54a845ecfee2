import random
import re
import zlib
from collections import Counter
from itertools import combinations

import pytest

from tillhouse.llm import variants
from tillhouse.llm.queries import queries

NAME = "op11_spelling_variants"


def one_edit(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) < len(b):
        a, b = b, a
    k = next((i for i in range(len(b)) if a[i] != b[i]), len(b))
    return a[k + 1 :] == (b[k + 1 :] if len(a) == len(b) else b[k:])


def by_hand(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts = Counter()
    for r in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r["text"] or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if r['doc_id'] is None else r['doc_id']}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 6 and c >= 5}
    near = {w: [] for w in n}
    for a, b in combinations(n, 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    found = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        found.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(found)


def result(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, df.collect()))


def test_whole_query_on_messy_documents(spark, messy, rows):
    found = result(queries()[NAME](spark, messy))
    assert found == by_hand(rows)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    found = result(queries()[NAME](spark, "/root/testdata/sf0.01"))
    assert found == by_hand([r.asDict() for r in docs]) and any(r[1] for r in found)


def variant_rows(rng, bases, copies):
    """Words, their misspellings and misspellings of those, each often enough to count."""
    texts = []
    for base in bases:
        texts += [base] * 200
        for _ in range(copies):
            w = base
            for times in (30, 6):
                k, c = rng.randrange(len(w)), rng.choice("abcdeàéÿ")
                w = rng.choice([w[:k] + w[k + 1 :], w[:k] + c + w[k:], w[:k] + c + w[k + 1 :]])
                texts += [w] * times
    rng.shuffle(texts)
    return [{"doc_id": i, "text": " ".join(texts[i::40])} for i in range(40)]


@pytest.mark.parametrize("crowd, big_crowd", [(variants.CROWD, variants.BIG_CROWD), (2, 3), (2, 1000), (1, 1)])
def test_crowds_lose_no_pair(spark, crowd, big_crowd):
    rng = random.Random(5)
    bases = ["".join(rng.choice("abcdéf") for _ in range(rng.randint(7, 11))) for _ in range(8)] + ["aaaaaaaa", "abababab", "babababa"]
    rows = variant_rows(rng, bases, 12)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = result(variants.spelling_variants(df, crowd=crowd, big_crowd=big_crowd))
    assert found == by_hand(rows)
    assert any(r[1] and r[2] != r[1] for r in found)  # chains of forms


@pytest.mark.parametrize("parts, pieces", [(1, 7), (1, 3), (2, 4), (3, 2)])
def test_near_words_share_a_signature(parts, pieces):
    rng = random.Random(parts)
    for _ in range(300):
        w = "".join(rng.choice("abcdefgh") for _ in range(rng.randint(6, 14)))
        k, c = rng.randrange(len(w)), rng.choice("abxyz")
        other = rng.choice([w[:k] + w[k + 1 :], w[:k] + c + w[k:], w[:k] + c + w[k + 1 :]])
        a, b = variants.signatures([w, other], parts, pieces)
        assert set(a) & set(b)
    with pytest.raises(ValueError):
        variants.signatures(["abcdef"], 1, 2)


def test_long_chain_of_forms(spark):
    """Each word is five times as frequent as the next, one edit away."""
    word, rows = "abcdefgh", []
    for level in range(7):
        rows.append({"doc_id": None, "text": (word + " ") * (5 * 5 ** (6 - level))})
        word = word[:level] + "z" + word[level + 1 :] if level < 7 else word
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = result(variants.spelling_variants(df))
    assert found == by_hand(rows) and {r[2] for r in found} == {"abcdefgh"}


def test_empty_table(spark, empty):
    assert result(queries()[NAME](spark, empty)) == []
