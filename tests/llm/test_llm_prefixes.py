import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tillhouse.llm import prefixes
from tillhouse.llm.queries import queries

NAME = "op13_conversation_prefix_trie"
SCHEMA = "conv_id long, turn long, role string, text string"


def conversations_of(rows):
    """conv_id -> rebuilt list of (role, text)."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            md5 = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append((turn is not None, turn or 0, role, md5, text))
    own = {c: [(t[2], t[4]) for t in sorted(turns)] for c, turns in own.items()}
    found = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        found[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return found


def by_hand(rows):
    members = {}
    for c, turns in conversations_of(rows).items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append((c, len(turns)))
    children, found = {}, []
    for key in members:
        if key:
            children.setdefault(key[:-1], []).append(key)

    def words(key):
        return len(re.findall("[^\x20\x09-\x0d]+", key[-1][1])) if key else 0

    leaves, saved = {}, {}
    for key in sorted(members, key=len, reverse=True):
        below = children.get(key, [])
        leaves[key] = sum(leaves[k] for k in below) if below else 1
        saved[key] = (len(members[key]) - 1) * words(key) + sum(saved[k] for k in below)
    for key, own in members.items():
        ends = ",".join(str(c) for c in sorted(c for c, n in own if n == len(key)))
        parent = min(members[key[:-1]])[0] if key else None
        found.append(
            (len(key), min(own)[0], parent, len(own), len(children.get(key, [])), leaves[key], saved[key],
             hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(found, key=str)


def result(df):
    return sorted((tuple(r[c] for c in prefixes.NODE) for r in df.collect()), key=str)


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    df = queries()[NAME](spark, folder)
    assert result(df) == by_hand(rows)
    assert all(t == "bigint" for c, t in df.dtypes if c != "ends_sha256")


def bushy(seed, n=90, letters="ab"):
    """Conversations over few distinct turns: long common prefixes, many equal ones."""
    rng, rows = random.Random(seed), []
    for _ in range(n):
        c = rng.randrange(400)
        for turn in range(rng.randint(1, 6)):
            rows.append((c, turn if rng.random() < 0.95 else None, rng.choice(["user", None]), rng.choice(letters) * 2 + " x" * rng.randint(0, 2)))
    return rows


@pytest.mark.parametrize("block", [1, 7, 60, 10_000])
def test_blocks_do_not_matter(spark, block):
    rows = bushy(1) + [(1000, k, "user", "aa") for k in range(40)] + [(2000 + i, 0, "user", "aa") for i in range(50)]
    found = prefixes.prefix_trie(table(spark, rows), block_turns=(block, block))
    assert result(found) == by_hand(rows)


def test_one_group_of_equal_conversations_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(prefixes, "IDS_AT_ONCE", 3)
    rows = [(20 * i, k, "user", f"hello {k}") for i in range(120) for k in range(2)] + [(7, 0, "a", "other")]
    found = prefixes.prefix_trie(table(spark, rows), block_turns=(20, 20))
    assert result(found) == by_hand(rows)


def test_messy_conversations(spark, tmp_path):
    rows = bushy(2, 40) + [
        (None, 0, "user", "nobody's"), (3, None, None, None), (3, None, None, None), (5, 1, "user", ""), (5, 1, "user", "tie"),
        (5, 1, "assistant", "tie"), (-5, 0, "user", "negative"), (41, 0, "u", "x"), (43, 0, "u", "y"), (46, 0, "u", "z"), (47, 0, "u", "w"),
        (9, 0, "user", "word " * 50_000), (9, 0, "user", "word " * 50_000), (11, 0, "ab", "c"), (11, 1, "a", "bc"),
    ]
    df = table(spark, rows).selectExpr("*", "1 AS k", "2 AS seq", "'x' AS turn_hash", "4 AS words", "5 AS block")
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    # -5 - (-5) % 20 is 0 in SQL and -20 in Python: neither conversation is there
    found = result(queries()[NAME](spark, str(tmp_path)))
    assert found == by_hand(rows)
    assert any(turns == [] for turns in conversations_of(rows).values())


def test_empty_table(spark, tmp_path):
    table(spark, []).write.parquet(f"{tmp_path}/conversations.parquet")
    assert queries()[NAME](spark, str(tmp_path)).count() == 0


def test_extents_and_range_minimum():
    rng = np.random.default_rng(0)
    for n in (1, 2, 3, 17, 64, 100):
        lcp = np.r_[-1, rng.integers(0, 4, n - 1)]
        levels = prefixes.sparse_table(lcp)
        at, depth = np.repeat(np.arange(n), 5), np.tile(np.arange(5), n)
        left, right = prefixes.extents(levels, at, depth)
        for p, d, a, b in zip(at, depth, left, right, strict=True):
            x, y = p, p
            while x > 0 and lcp[x] >= d:
                x -= 1
            while y < n - 1 and lcp[y + 1] >= d:
                y += 1
            assert (a, b) == (x, y)
        assert list(prefixes.range_min(levels, left, right)) == [lcp[a : b + 1].min() for a, b in zip(left, right, strict=True)]
