"""Trie of the turns that conversations begin with, from sorted sequences and no stack.

Each turn is a 128-bit hash, each conversation a string of them. Conversations are
sorted over the cluster and cut into blocks of neighbours. In a block, sparse tables over
the common prefixes of neighbours (LCPs) answer range-minimum questions, and for every
candidate prefix two binary searches in them, one to each side, give the interval of its
members; its parent's interval is searched the same way. Everything a node reports is a
difference of prefix sums, or a range minimum, over its interval.

A prefix that a block's border cuts gives a part in each of its blocks; these parts, at
most two depths' worth a block, are added up by the hash of the prefix.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillhouse.llm.shared import WORD, stored, text_or_empty

#: Conversations whose numbers agree up to this share their first turns with the first.
FAMILY = 20
MOST_SHARED = 3
TURN_BYTES = 16
#: Turns of a block: a 64th of all, but between these.
BLOCK_TURNS = (1 << 13, 1 << 20)
#: Ids in one row on their way to a checksum.
IDS_AT_ONCE = 1024
BEFORE, AFTER = -1, 1 << 62
NO_ENDS = hashlib.sha256(b"").hexdigest()

NODE = ["depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


# ---- conversations as sequences -------------------------------------------------------


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, k (from 1), turn_hash (hex), n_words of every turn, in order of `turn`,
    null first; equal turns by role, then hash."""
    role, text = text_or_empty("role"), text_or_empty("text")
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        role.alias("role"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("turn_hash"),
        F.regexp_count(text, F.lit(WORD)).alias("n_words"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "turn_hash")
    return rows.select("conv_id", F.row_number().over(order).alias("k"), "turn_hash", "n_words")


def rebuilt(own: DataFrame) -> DataFrame:
    """`turns` of rebuilt conversations: the first h of the family's first conversation,
    then one's own after the first h. A row with k = 0 and no turn stands for each
    conversation, so that one without turns is there, too."""
    shared = F.crc32(F.col("conv_id").cast("string")) % (MOST_SHARED + 1)
    ids = own.filter("k = 1").select("conv_id", F.lit(0).alias("k"), F.lit(None).cast("string").alias("turn_hash"), F.lit(0).alias("n_words"))
    tails = own.filter(F.col("k") > shared)
    heads = own.filter((F.col("k") <= MOST_SHARED) & (F.col("conv_id") % FAMILY == 0))
    heads = heads.select(F.col("conv_id").alias("first"), "k", "turn_hash", "n_words")
    takers = own.filter("k = 1").select("conv_id", shared.alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("first"))
    given = takers.filter("h > 0").join(heads, "first").filter(F.col("k") <= F.col("h")).select("conv_id", "k", "turn_hash", "n_words")
    return ids.unionByName(tails).unionByName(given)


def sequences(rows: DataFrame) -> DataFrame:
    """conv_id, seq (16 bytes a turn), words (of each turn)."""
    turn = F.struct("k", "turn_hash", "n_words")
    all_ = F.filter(F.array_sort(F.collect_list(turn)), lambda t: t["k"] > 0)
    grouped = rows.groupBy("conv_id").agg(all_.alias("t"))
    return grouped.select(
        "conv_id",
        F.unhex(F.array_join(F.transform("t", lambda t: t["turn_hash"]), "")).alias("seq"),
        F.transform("t", lambda t: t["n_words"]).alias("words"),
    )


# ---- one block --------------------------------------------------------------------------


def sparse_table(values: np.ndarray) -> list[np.ndarray]:
    """Level k holds the minimum of 2 ** k values from each place on."""
    levels = [values]
    while 2 << (len(levels) - 1) <= len(values):
        last, half = levels[-1], 1 << (len(levels) - 1)
        levels.append(np.minimum(last[:-half], last[half:]))
    return levels


def range_min(levels: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    k = np.frexp((right - left + 1).astype(np.float64))[1] - 1
    out = np.empty(len(left), dtype=levels[0].dtype)
    for level in np.unique(k):
        at = k == level
        out[at] = np.minimum(levels[level][left[at]], levels[level][right[at] + 1 - (1 << int(level))])
    return out


def extents(levels: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place around `at` between which neighbours share `depth` turns.
    `levels` is of the common prefixes, each with the place before."""
    n = len(levels[0])
    left, right = at.copy(), at.copy()
    for k in range(len(levels) - 1, -1, -1):
        size = 1 << k
        fits = right + size <= n - 1
        shared = levels[k][np.where(fits, right + 1, 0)] >= depth
        right = np.where(fits & shared, right + size, right)
        fits = left - size >= 0
        shared = levels[k][np.where(fits, left - size + 1, 0)] >= depth
        left = np.where(fits & shared, left - size, left)
    return left, right


def common_turns(a: bytes, b: bytes) -> int:
    m = min(len(a), len(b))
    if a[:m] == b[:m]:
        return m // TURN_BYTES
    differs = np.frombuffer(a, np.uint8, m) != np.frombuffer(b, np.uint8, m)
    return int(differs.argmax()) // TURN_BYTES


def _prefix_ids(seq: bytes, most: int) -> list[bytes]:
    """Hashes of the prefixes of 0, 1, … `most` turns."""
    h, found = hashlib.blake2b(digest_size=16), []
    for d in range(most + 1):
        if d:
            h.update(seq[(d - 1) * TURN_BYTES : d * TURN_BYTES])
        found.append(h.digest())
    return found


BLOCK = (
    "kind int, node binary, depth long, conv_id long, parent binary, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, ends_sha256 string, place long, ids binary"
)
INTERIOR, PART, ENDS = 0, 1, 2


def block_nodes(pdf: pd.DataFrame) -> pd.DataFrame:
    """Nodes of one block; the last row of the block before and the first of the block
    after may be there with the places BEFORE and AFTER."""
    pdf = pdf.sort_values("pos")
    before = pdf.loc[pdf["pos"] == BEFORE, "seq"].to_list()
    after = pdf.loc[pdf["pos"] == AFTER, "seq"].to_list()
    pdf = pdf[(pdf["pos"] != BEFORE) & (pdf["pos"] != AFTER)]
    seqs, conv_ids, n = pdf["seq"].to_list(), pdf["conv_id"].to_numpy(np.int64), len(pdf)
    lens = np.array([len(s) // TURN_BYTES for s in seqs], dtype=np.int64)
    lcp = np.array([-1] + [common_turns(a, b) for a, b in zip(seqs, seqs[1:], strict=False)], dtype=np.int64)
    inside = sparse_table(lcp.copy())
    lcp[0] = common_turns(before[0], seqs[0]) if before else -1
    cut_after = common_turns(seqs[-1], after[0]) if after else -1
    cut_before = int(lcp[0])
    lcp_next = np.r_[lcp[1:], cut_after]

    flat = np.concatenate([np.asarray(w, dtype=np.int64) for w in pdf["words"]] or [np.zeros(0, np.int64)])
    running, starts = np.r_[0, np.cumsum(flat)], np.r_[0, np.cumsum(lens)[:-1]]

    def words_of(place: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Words in the first turns of a conversation."""
        return running[starts[place] + depth] - running[starts[place]]

    every = np.arange(n)
    whole = words_of(every, lens)
    sum_words = np.r_[0, np.cumsum(whole)]
    sum_new = np.r_[0, np.cumsum(whole - words_of(every, np.maximum(lcp, 0)))]
    sum_leaves = np.r_[0, np.cumsum(lcp_next < lens)]
    least = sparse_table(conv_ids)

    # Candidates: what a conversation does not share with the one before, and at the
    # block's beginning also what it does.
    count = lens - lcp
    place = np.repeat(every, count)
    depth = np.arange(len(place)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lcp + 1, count)
    first_of = np.sort(depth * (n + 1) + place)
    place, depth = np.r_[np.zeros(cut_before + 1, np.int64), place], np.r_[np.arange(cut_before + 1), depth]

    left, right = extents(inside, place, depth)
    shared = words_of(left, np.maximum(depth - 1, 0))
    begins = depth > lcp[left]
    size = right - left + 1
    new = np.where(begins, sum_new[right + 1] - sum_new[left + 1] + whole[left] - shared, sum_new[right + 1] - sum_new[left])
    below = (depth + 1) * (n + 1)
    children = np.searchsorted(first_of, below + right, "right") - np.searchsorted(first_of, below + left, "left")

    def cut(l: np.ndarray, r: np.ndarray, d: np.ndarray) -> np.ndarray:
        return (l == 0) & (d <= cut_before) | (r == n - 1) & (d <= cut_after)

    up = np.maximum(depth - 1, 0)
    up_left, up_right = extents(inside, left, up)
    is_cut, up_cut = cut(left, right, depth), cut(up_left, up_right, up) & (depth > 0)
    ids_first, ids_last = _prefix_ids(seqs[0], max(cut_before, 0)), _prefix_ids(seqs[-1], max(cut_after, 0))

    def id_of(l: int, d: int) -> bytes:
        return ids_first[d] if l == 0 and d <= cut_before else ids_last[d]

    # Conversations that end at a node are neighbours, in order of their ids.
    same = np.r_[False, (lcp[1:] == lens[1:]) & (lens[1:] == lens[:-1])]
    breaks = np.r_[np.flatnonzero(~same), n]
    last_same = np.repeat(breaks[1:] - 1, np.diff(breaks))
    ending = lens[left] == depth
    sha, chunks = [NO_ENDS] * len(left), []
    for x in np.flatnonzero(ending):
        own = conv_ids[left[x] : last_same[left[x]] + 1]
        if not is_cut[x]:
            sha[x] = hashlib.sha256(",".join(map(str, own.tolist())).encode()).hexdigest()
            continue
        for lo in range(0, len(own), IDS_AT_ONCE):
            some = own[lo : lo + IDS_AT_ONCE]
            chunks.append((id_of(left[x], depth[x]), int(pdf["pos"].iloc[left[x] + lo]), some.astype("<i8").tobytes()))
    up_conv = pd.array(range_min(least, up_left, up_right), dtype="Int64")
    up_conv[up_cut | (depth == 0)] = pd.NA
    nodes = pd.DataFrame(
        {
            "kind": np.where(is_cut, PART, INTERIOR).astype(np.int32),
            "node": [id_of(p, d) if c else None for p, d, c in zip(left, depth, is_cut, strict=True)],
            "depth": depth,
            "conv_id": range_min(least, left, right),
            "parent": [id_of(p, d) if c else None for p, d, c in zip(up_left, up, up_cut, strict=True)],
            "parent_conv_id": up_conv,
            "n_convs": size,
            "n_children": children,
            "n_leaves": sum_leaves[right + 1] - sum_leaves[left],
            "saved_tokens": sum_words[right + 1] - sum_words[left] - size * shared - new,
            "ends_sha256": sha,
            "place": pd.array([pd.NA] * len(left), dtype="Int64"),
            "ids": [None] * len(left),
        }
    )
    if not chunks:
        return nodes
    ends = pd.DataFrame(chunks, columns=["node", "place", "ids"]).assign(kind=np.int32(ENDS))
    return pd.concat([nodes.astype(object), ends.astype(object)], ignore_index=True).astype({"kind": "int32"})


# ---- on Spark ---------------------------------------------------------------------------


def _checksums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(node, ends_sha256) of rows sorted by node and place, one piece at a time."""
    node, h, empty = None, None, True
    for pdf in frames:
        done = []
        for own, ids in zip(pdf["node"], pdf["ids"], strict=True):
            own = bytes(own)
            if own != node:
                if node is not None:
                    done.append((node, h.hexdigest()))
                node, h, empty = own, hashlib.sha256(), True
            text = ",".join(map(str, np.frombuffer(ids, "<i8").tolist()))
            h.update((text if empty else "," + text).encode())
            empty = False
        yield pd.DataFrame(done, columns=["node", "ends_sha256"])
    if node is not None:
        yield pd.DataFrame([(node, h.hexdigest())], columns=["node", "ends_sha256"])


def sequence_trie(seqs: DataFrame, block_turns: tuple[int, int] = BLOCK_TURNS) -> DataFrame:
    """Nodes of the trie of `sequences`."""
    seqs = stored(seqs, "sequences")
    total = seqs.agg(F.coalesce(F.sum(F.size("words") + 1), F.lit(0))).first()[0]
    least, most = block_turns
    blocks = max(1, -(-total // min(max(total // 64, least), most)))
    ordered = seqs.repartitionByRange(blocks, "seq", "conv_id").sortWithinPartitions("seq", "conv_id")
    ordered = stored(ordered.withColumn("pos", F.monotonically_increasing_id()), "sorted")
    ordered = ordered.withColumn("block", F.shiftright("pos", 33))
    # A row a block: its neighbours' nearest sequences.
    ends = ordered.groupBy("block").agg(F.min_by("seq", "pos").alias("first"), F.max_by("seq", "pos").alias("last"))
    line = Window.orderBy("block")
    ends = ends.select("block", F.lag("last").over(line).alias("before"), F.lead("first").over(line).alias("after"))
    borders = F.explode(
        F.array(
            F.struct(F.lit(BEFORE).cast("long").alias("pos"), F.col("before").alias("seq")),
            F.struct(F.lit(AFTER).cast("long").alias("pos"), F.col("after").alias("seq")),
        )
    )
    borders = ends.select("block", borders.alias("b")).select("block", "b.*").filter("seq is not null")
    borders = borders.withColumns({"conv_id": F.lit(0).cast("long"), "words": F.array().cast("array<int>")})
    found = ordered.unionByName(borders).groupBy("block").applyInPandas(block_nodes, BLOCK)
    found = stored(found, "blocks")

    pieces = found.filter(F.col("kind") == ENDS).select("node", "place", "ids")
    pieces = pieces.repartition("node").sortWithinPartitions("node", "place")
    sums = pieces.mapInPandas(_checksums, "node binary, ends_sha256 string")
    parts = found.filter(F.col("kind") == PART).groupBy("node", "depth", "parent")
    added = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    cut = parts.agg(F.min("conv_id").alias("conv_id"), *added).join(sums, "node", "left")
    cut = stored(cut.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS))), "cut-prefixes")
    above = cut.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    whole = found.filter(F.col("kind") == INTERIOR)
    settled = whole.filter("parent is null").select(*NODE)
    rest = whole.filter("parent is not null").drop("parent_conv_id").join(above, "parent")
    return settled.unionByName(rest.select(*NODE)).unionByName(cut.join(above, "parent", "left").select(*NODE))


def prefix_trie(conversations: DataFrame, block_turns: tuple[int, int] = BLOCK_TURNS) -> DataFrame:
    """A row per node of the trie of rebuilt `conversations` (conv_id, turn, role, text).

    Rows without a conv_id belong to no conversation. A repeated row is a turn of its own.
    Turns with one number come by role, then by a hash of role and text. Turns are told
    apart by 128 bits of hash. An empty table has no node, not even the root. Other
    columns are not looked at. The turns of one conversation, some 20 bytes each, are
    sorted in one task; conversations with equal turns spread over blocks.
    """
    return sequence_trie(sequences(rebuilt(stored(turns(conversations), "turns"))), block_turns)
