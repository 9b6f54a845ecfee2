import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tillhouse.llm import repeats
from tillhouse.llm.queries import queries

NAME = "op4_suffix_array_dedup"


def by_hand(rows, length=100):
    """rows: (doc_id, bytes) in order; what is left of each."""
    seen, out = set(), []
    for i, b in rows:
        covered = bytearray(len(b))
        for k in range(len(b) - length + 1):
            w = b[k : k + length]
            if w in seen:
                covered[k : k + length] = b"\1" * length
            else:
                seen.add(w)
        kept = bytes(x for x, c in zip(b, covered, strict=True) if not c)
        spans = len([p for p in bytes(covered).split(b"\0") if p])
        out.append((i, len(b), sum(covered), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_messy_documents(spark, messy, rows):
    # Rows of one id are ordered by a hash of their text; the two that share one here
    # repeat earlier documents, so that their order makes no difference.
    ordered = sorted(((r["doc_id"], (r["text"] or "").encode()) for r in rows), key=lambda r: (r[0] is None, r[0] or 0))
    found = [tuple(r) for r in queries()[NAME](spark, messy).collect()]
    assert sorted(found, key=str) == sorted(by_hand(ordered), key=str)


def test_empty_table(spark, empty):
    assert queries()[NAME](spark, empty).count() == 0


def test_a_common_passage_in_many_texts(spark, monkeypatch):
    """Its edges have a different segment in every text; cut into windows or not, the
    result is the same."""
    rng = random.Random(12)
    draw = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    passage = draw(300)
    rows = [(k, draw(rng.randint(0, 250)) + passage + draw(rng.randint(0, 250))) for k in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    expected = sorted(by_hand([(k, t.encode()) for k, t in rows]))
    for many in (8, 10**6):
        monkeypatch.setattr(repeats, "MANY", many)
        assert (len(repeats._crowded_anchors(repeats._keyed(df, "doc_id", "text"), 80)) > 0) == (many == 8)
        assert sorted(map(tuple, repeats.without_repeats(df).collect())) == expected


def test_kept_text_and_one_of_repeated_rows(spark):
    rng = random.Random(8)
    text = "".join(rng.choices("abcdefgh", k=150))
    df = spark.createDataFrame([(1, text), (1, text), (2, "x" + text[20:])], "doc_id long, text string")
    got = sorted((r["doc_id"], bytes(r["kept"])) for r in repeats.without_repeats(df, with_text=True).collect())
    assert got == [(1, b""), (1, text.encode()), (2, b"x")]


@pytest.mark.parametrize("seed", range(6))
def test_windows_against_a_set(seed):
    rng = random.Random(seed)
    for _ in range(40):
        strings = [bytes(rng.choices(b"ab", k=rng.randint(0, 30))) for _ in range(rng.randint(1, 20))]
        length = rng.choice([1, 2, 3, 5, 8, 10])
        seen, expected = set(), []
        for s in strings:
            expected.append([])
            for k in range(len(s) - length + 1):
                expected[-1].append(s[k : k + length] in seen)
                seen.add(s[k : k + length])
        got = repeats.repeated_windows(strings, length, rng.choice([5, 20, 1000]))
        assert [list(map(bool, x)) for x in got] == expected


def test_windows_left_out_are_not_shared():
    rng = random.Random(7)
    for _ in range(60):
        strings = [bytes(rng.choices(b"abc", k=rng.randint(0, 14))) for _ in range(rng.randint(1, 15))]
        length = rng.randint(1, 9)
        windows = [[s[k : k + length] for k in range(len(s) - length + 1)] for s in strings]
        often = Counter(w for own in windows for w in own)
        for own, first, last in zip(windows, *repeats.shared_windows(strings, length), strict=True):
            shared = [k for k, w in enumerate(own) if often[w] > 1]
            assert (first, last) == (shared[0], shared[-1]) if shared else last < first


@pytest.mark.parametrize("depth,step", [(50, 10), (45, 5), (44, 4), (42, 2), (41, 1)])
def test_merged_order_is_the_sorted_order(depth, step):
    rng = random.Random(9)
    strings = [bytes(rng.choices(b"abc", k=rng.randint(1, 40))) for _ in range(30)]
    order, _, left = repeats.merge(strings, [range(0, 7), range(7, 8), range(8, 30)], depth)
    text, _, _ = repeats._layout(strings, step)
    suffixes = [bytes(text[p : p + left[p]]) for p in order if left[p] > 0]
    assert suffixes == sorted(suffixes)


def test_segments_cover_every_window_once():
    rng = random.Random(4)
    texts = [bytes(rng.choices(b"abcd ", k=rng.randint(90, 600))) for _ in range(30)]
    texts += [texts[0][:150] + b"X" + texts[0][150:], b"ab" * 200, b"ab" * 150 + b"c"]
    ends = np.cumsum([len(t) for t in texts])
    raw = b"".join(texts)
    anchors = {}
    for start, windows, anchor in zip(*repeats.segments(np.frombuffer(raw, dtype=np.uint8), ends), strict=True):
        for k in range(start, start + windows):
            assert k not in anchors
            anchors[k] = anchor
    expected = {e - len(t) + k for e, t in zip(ends, texts, strict=True) for k in range(len(t) - 99)}
    assert set(anchors) == expected
    by_window = {}
    assert all(by_window.setdefault(raw[k : k + 100], a) == a for k, a in anchors.items())


def test_small_pieces_and_flushes_change_nothing(spark, messy, rows, monkeypatch):
    texts = sorted(((r["doc_id"], (r["text"] or "").encode()) for r in rows if r["doc_id"] is not None), key=str)[:30]
    import pyarrow as pa

    def windows(batches):
        out = set()
        for b in batches:
            for r in b.to_pylist():
                out |= {(r["doc_id"], k) for k in range(r["start"], r["start"] + r["windows"])}
        return out

    def run():
        ids, data = zip(*texts, strict=True)
        batch = pa.RecordBatch.from_arrays(
            [pa.array(ids), pa.array([hash(d) for d in data]), pa.array(data, pa.binary())], names=["a", "b", "c"]
        )
        return windows(repeats._emit([batch], np.zeros(0, dtype=np.int64)))

    whole = run()
    monkeypatch.setattr(repeats, "PIECE", 500)
    monkeypatch.setattr(repeats, "FLUSH", 100)
    assert run() == whole
