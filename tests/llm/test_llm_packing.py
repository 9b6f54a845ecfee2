import itertools
import random
import sys
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tillhouse.llm import packing
from tillhouse.llm.queries import queries

NAME = "op7_vector_best_fit_packing"


def test_pieces_of_messy_documents(spark, messy, rows):
    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    expected = []
    for r in rows:
        ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            own = np.array(ids[start : start + 2048], dtype="<u4")
            expected.append((r["doc_id"], piece, start, len(own), zlib.crc32(own.tobytes())))
    found = queries()[NAME](spark, messy).toPandas()
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = [tuple(r) for r in spark.createDataFrame(found[columns].astype(object).where(found[columns].notna(), None), "doc_id double, piece int, start long, length long, ids_crc32 long").collect()]
    assert sorted(got, key=str) == sorted(((float(a) if a is not None else None, *b) for a, *b in expected), key=str)
    for _, g in found.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert list(g["offset"]) == [0, *np.cumsum(g["length"])[:-1]]
        assert g["length"].sum() <= 2048


def test_empty_table(spark, empty):
    assert queries()[NAME](spark, empty).count() == 0


@pytest.mark.parametrize("by", ["residual", "dot"])
def test_every_constraint_holds(by):
    rng = random.Random(3)
    lengths = np.array([rng.choice([1, 5, 30, 64, rng.randint(1, 64)]) for _ in range(900)])
    capacity = packing.Capacity(64, 4, 1500, by=by) if by == "dot" else packing.Capacity(64, 4, 4096)
    if by == "dot":
        lengths = np.minimum(lengths, 38)
    sequence, offset = packing.best_fit(lengths, capacity)
    for s in set(sequence):
        own = lengths[sequence == s]
        assert own.sum() <= 64 and len(own) <= 4 and (own**2).sum() <= capacity.cost
        assert sorted(offset[sequence == s]) == sorted(np.r_[0, np.cumsum(own[np.argsort(offset[sequence == s])])[:-1]])
    bound = max(lengths.sum() / 64, len(lengths) / 4, (lengths**2).sum() / capacity.cost)
    assert len(set(sequence)) <= 1.25 * bound + 1


def test_a_piece_that_fits_nowhere_is_an_error():
    with pytest.raises(ValueError):
        packing.best_fit(np.array([10]), packing.Capacity(64, 4, 50))


def test_near_the_fewest(spark):
    found = queries()[NAME](spark, "/root/testdata/sf0.001").selectExpr(
        "count(distinct sequence_id) n", "ceil(sum(length) / 2048) least"
    ).first()
    assert found["n"] <= found["least"] * 1.02 + 1


def test_words_forgotten_in_between(spark, messy, rows, monkeypatch):
    path = packing.default_tokenizer()
    texts = [r["text"] for r in rows][:40]
    whole = list(packing.encode(texts, path))
    monkeypatch.setattr(packing, "REMEMBERED", 5)
    assert list(packing.encode(texts, path)) == whole


def test_ids_come_along(spark, messy):
    docs = spark.read.parquet(f"{messy}/documents.parquet")
    for r in packing.pack(docs, with_ids=True).limit(20).collect():
        assert zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]


class FourIds:
    """In place of a tokenizer."""

    ids = [1, 2, 3, 4]

    def encode_batch_fast(self, words, add_special_tokens):
        return [self] * len(words)


def remembered_mb():
    held = [packing._recent, packing._older]
    return sum(map(sys.getsizeof, held + [x for d in held for x in itertools.chain(d, d.values())])) / 1e6


def test_remembered_words_leave_room_for_other_operators(monkeypatch):
    monkeypatch.setattr(packing, "_tokenizer", lambda path: FourIds())
    texts = (" ".join(f"w{k:x}" for k in range(lo, lo + 25_000)) for lo in range(0, 1_500_000, 25_000))
    assert sum(len(x) for x in packing.encode(texts, "four", packing.REMEMBERED_BESIDE_OTHERS)) == 1_500_000 * 16 + 60 * 4
    assert len(packing._recent) + len(packing._older) > 300_000
    assert remembered_mb() < 125


def test_long_words_are_not_remembered(monkeypatch):
    monkeypatch.setattr(packing, "_tokenizer", lambda path: FourIds())
    texts = [f"{k:010000} short {k:010000}" for k in range(500)] * 2
    assert list(packing.encode(texts, "long")) == [np.array([1, 2, 3, 4] * 3 + [0], dtype="<u4").tobytes()] * 1000
    assert remembered_mb() < 0.1
