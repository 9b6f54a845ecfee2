"""Removal of repeated byte strings, found in merged Burrows-Wheeler transforms.

Bytes covered by a LENGTH-byte string that also starts earlier are removed. To share
the work out, each LENGTH-byte window is named by its anchor, the ANCHOR-byte string
in it of least hash (the leftmost of equals): equal windows have equal anchors, so
windows are compared only with those of the same anchor. Consecutive windows with one
anchor form a segment. Three steps:

1. Segments of equal bytes (128 bits of hashes) are one class; all but the first in
   document order are repeats. Map tasks settle this among their own segments before
   anything is shuffled, so a passage that is everywhere travels once per task.
   Anchors that many different segments have (found in a bounded sample of the texts,
   which decides nothing but the way taken) would meet in one task; their segments are
   cut into single windows here, which spread by their own hashes.
2. An anchor with one class is done. The first segments of the other classes get their
   bytes, and go by anchor into lots.
3. In a lot, windows that have the hash of no other are cut off segments at either end.
   Shards of what is left get a Burrows-Wheeler transform each. The transforms are merged
   by refining their interleaving ten characters at a time; the blocks of suffixes
   that still agree after LENGTH characters are the repeated strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillhouse.llm.shared import stored

LENGTH = 100
ANCHOR = 32
#: Bytes hashed at once; longer texts are read in pieces that overlap.
PIECE = 1 << 20
#: Segments that a map task compares among themselves.
FLUSH = 400_000
#: About so many texts are looked at for anchors with MANY different segments.
SAMPLE_TEXTS = 20_000
MANY = 32
#: Bytes of text for a bucket of step 1, bytes of segments for a lot and a shard of step 3.
BUCKET_BYTES = 8 << 20
LOT_BYTES = 2 << 20
SHARD_BYTES = 128 << 10

SEGMENTS = "kind int, anchor long, bytes_hash long, doc_id long, text_hash long, start long, windows int"
FOUND, SETTLED, ASKED = 0, 1, 2

_rng = np.random.default_rng(20)
_letters = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_PLACE = np.uint64((1 << 22) - 1)


# ---- segments ------------------------------------------------------------------------


def _anchor_hashes(raw: np.ndarray) -> np.ndarray:
    """Hash of the ANCHOR bytes from each place on."""
    h, n = _letters[raw], 1
    while n < ANCHOR:
        h = h[:-n] * _A + h[n:] * _B
        h ^= h >> np.uint64(31)
        n *= 2
    return h


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of `width` values from each place on."""
    n = 1
    while 2 * n <= width:
        values = np.minimum(values[:-n], values[n:])
        n *= 2
    return np.minimum(values[: len(values) - (width - n)], values[width - n :]) if width > n else values


def segments(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """start, number of windows and anchor hash of the segments of texts that lie one
    after the other in `raw`, the k-th up to ends[k]."""
    empty = np.zeros(0, dtype=np.int64)
    if len(raw) < LENGTH:
        return empty, empty, empty
    h = _anchor_hashes(raw)
    marked = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
    least = _least(marked, LENGTH - ANCHOR + 1)
    valid = np.ones(len(least) + 1, dtype=bool)
    valid[-1] = False
    for end in ends[:-1]:  # windows that would cross into the next text
        valid[max(0, end - LENGTH + 1) : end] = False
    changed = np.ones(len(least) + 1, dtype=bool)
    changed[1:-1] = least[1:] != least[:-1]
    changed[1:] |= valid[1:] != valid[:-1]
    bounds = np.flatnonzero(changed)
    starts, stops = bounds[:-1], bounds[1:]
    keep = valid[starts]
    starts, stops = starts[keep], stops[keep]
    return starts, stops - starts, h[(least[starts] & _PLACE).astype(np.int64)].view(np.int64)


def _first_and_rest(t: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Rows that come first of their class, in order of anchors, and those that repeat
    one; the same place of the same text given twice counts once."""
    order = np.lexsort((t["start"], t["text_hash"], t["doc_id"], t["unknown"], t["windows"], t["bytes_hash"], t["anchor"]))
    o = {c: v[order] for c, v in t.items()}
    same = np.zeros(len(order), dtype=bool)
    same[1:] = True
    for c in ("anchor", "bytes_hash", "windows"):
        same[1:] &= o[c][1:] == o[c][:-1]
    place = same.copy()
    for c in ("unknown", "doc_id", "text_hash", "start"):
        place[1:] &= o[c][1:] == o[c][:-1]
    heads = np.maximum.accumulate(np.where(~same, np.arange(len(order)), 0))
    again = same.copy()  # the same place as the first of the class
    for c in ("unknown", "doc_id", "text_hash", "start"):
        again &= o[c] == o[c][heads]
    return order[~same], order[same & ~again & ~place]


def _batch(t: dict[str, np.ndarray], kind: int, rows: np.ndarray) -> pa.RecordBatch:
    doc = pa.array(t["doc_id"][rows], pa.int64(), mask=t["unknown"][rows])
    columns = [pa.array(np.full(len(rows), kind, dtype=np.int32)), pa.array(t["anchor"][rows]), pa.array(t["bytes_hash"][rows])]
    columns += [doc, pa.array(t["text_hash"][rows]), pa.array(t["start"][rows]), pa.array(t["windows"][rows].astype(np.int32))]
    return pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in SEGMENTS.split(", ")])


def _pieces(batches) -> Iterator[tuple[list, list[bytes]]]:
    """((doc_id, text hash, place) ..., bytes ...) of about PIECE bytes together."""
    names, parts, total = [], [], 0
    for batch in batches:
        ids, hashes, texts = batch.column(0), batch.column(1), batch.column(2)
        for k in range(batch.num_rows):
            data = texts[k].as_py()
            if not data or len(data) < LENGTH:
                continue
            for at in range(0, len(data) - LENGTH + 1, PIECE):
                part = data[at : at + PIECE + LENGTH - 1] if len(data) > PIECE else data
                names.append((ids[k].as_py(), hashes[k].as_py(), at))
                parts.append(part)
                total += len(part)
                if total >= PIECE:
                    yield names, parts
                    names, parts, total = [], [], 0
                if part is data:
                    break
    if parts:
        yield names, parts


def _all_segments(names: list, parts: list[bytes], crowded: np.ndarray) -> dict[str, np.ndarray]:
    ends = np.cumsum([len(p) for p in parts])
    data = b"".join(parts)
    starts, windows, anchors = segments(np.frombuffer(data, dtype=np.uint8), ends)
    cut = np.isin(anchors, crowded)
    if cut.any():  # windows of these are named by a hash of their own instead of the anchor
        lone = np.concatenate([np.arange(a, a + n) for a, n in zip(starts[cut], windows[cut], strict=True)])
        own = np.array([xxhash.xxh3_64_intdigest(data[a : a + LENGTH], 1) for a in lone.tolist()], dtype=np.uint64)
        starts, windows = np.r_[starts[~cut], lone], np.r_[windows[~cut], np.ones(len(lone), dtype=np.int64)]
        anchors = np.r_[anchors[~cut], own.view(np.int64)]
    text = np.searchsorted(ends, starts, side="right")
    tails = (starts + windows + (LENGTH - 1)).tolist()
    digest = xxhash.xxh3_64_intdigest
    hashes = np.array([digest(data[a:b]) for a, b in zip(starts.tolist(), tails, strict=True)], dtype=np.uint64)
    own = np.array([(i is None, i or 0, h, at) for i, h, at in names], dtype=np.int64).reshape(-1, 4)[text]
    return {
        "anchor": anchors, "bytes_hash": hashes.view(np.int64), "windows": windows.astype(np.int64),
        "unknown": own[:, 0].astype(bool), "doc_id": own[:, 1], "text_hash": own[:, 2],
        "start": starts - np.r_[0, ends[:-1]][text] + own[:, 3],
    }


def _emit(batches, crowded: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Step 1 among the texts of a task."""
    held: list[dict[str, np.ndarray]] = []

    def flush() -> Iterator[pa.RecordBatch]:
        t = {c: np.concatenate([h[c] for h in held]) for c in held[0]}
        held.clear()
        first, rest = _first_and_rest(t)
        yield _batch(t, FOUND, first)
        yield _batch(t, SETTLED, rest)

    for names, parts in _pieces(batches):
        held.append(_all_segments(names, parts, crowded))
        if sum(len(h["start"]) for h in held) >= FLUSH:
            yield from flush()
    if held:
        yield from flush()


def _settle(table: pa.Table) -> pa.Table:
    """Step 1 for the anchors of a bucket; ASKED are firsts of anchors with several classes."""
    kind = table.column("kind").to_numpy()
    passed = table.filter(pa.array(kind == SETTLED)).drop_columns(["bucket"])
    table = table.filter(pa.array(kind == FOUND))
    if not table.num_rows:
        return passed
    t = {c: table.column(c).to_numpy() for c in ("anchor", "bytes_hash", "text_hash", "start")}
    t["windows"] = table.column("windows").to_numpy().astype(np.int64)
    t["unknown"] = table.column("doc_id").is_null().to_numpy()
    t["doc_id"] = table.column("doc_id").fill_null(0).to_numpy()
    first, rest = _first_and_rest(t)
    anchor = t["anchor"][first]
    shared = np.zeros(len(first), dtype=bool)
    shared[1:] = anchor[1:] == anchor[:-1]
    shared[:-1] |= shared[1:].copy()
    mine = pa.Table.from_batches([_batch(t, SETTLED, rest), _batch(t, ASKED, first[shared])])
    return pa.concat_tables([passed.cast(mine.schema), mine])


# ---- transforms ------------------------------------------------------------------------


def shared_windows(strings: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """First and last window of each string that have the hash of another window, last
    before first if none has. What is outside repeats nothing and is not repeated."""
    lengths = np.array([len(s) for s in strings], dtype=np.int64)
    raw = np.frombuffer(b"".join(strings), dtype=np.uint8)
    first, last = lengths.copy(), np.full(len(strings), -1, dtype=np.int64)
    if len(raw) < length:
        return first, last
    h, n, done = _letters[raw], 1, 0
    whole = np.zeros(len(raw) - length + 1, dtype=np.uint64)
    while n <= length:
        if length & n:
            whole = whole * _B + h[done : done + len(whole)]
            whole ^= whole >> np.uint64(29)
            done += n
        if 2 * n <= length:
            h = h[:-n] * _A + h[n:] * _B
            h ^= h >> np.uint64(31)
        n *= 2
    ends = np.cumsum(lengths)
    string = np.repeat(np.arange(len(strings)), lengths)[: len(whole)]
    inside = np.arange(len(whole)) + length <= ends[string]
    _, inverse, counts = np.unique(whole[inside], return_inverse=True, return_counts=True)
    hit = np.flatnonzero(inside)[counts[inverse] > 1]
    place = hit - (ends - lengths)[string[hit]]
    np.minimum.at(first, string[hit], place)
    np.maximum.at(last, string[hit], place)
    return first, last


def _layout(strings: list[bytes], pad: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of strings laid one after the other, each followed by `pad` ends, and the
    first place and the end of each. Symbols are bytes of UTF-8 (never 255) plus one; 0
    ends a string."""
    text = np.frombuffer((b"\0" * pad).join(strings) + b"\0" * pad, dtype=np.uint8) + np.uint8(1)
    lengths = np.array([len(s) for s in strings])
    starts = np.r_[0, np.cumsum(lengths + pad)[:-1]]
    stops = starts + lengths
    for k in range(pad):
        text[stops + k] = 0
    return text, starts, stops


def suffix_order(strings: list[bytes]) -> np.ndarray:
    """Places of all non-empty suffixes of a shard, sorted; equal ones as the strings are.

    The symbols before the suffixes, read in this order, are the shard's transform.
    """
    text, starts, stops = _layout(strings, 1)
    n, step = len(text), 7
    string = np.repeat(np.arange(len(strings)), stops - starts + 1)
    left = np.repeat(stops, stops - starts + 1) - np.arange(n)  # symbols to the string's end
    key = np.zeros(n, dtype=np.int64)
    for k in range(step):
        key <<= 8
        m = max(0, n - k)
        key[:m] |= np.where(left[:m] > k, text[n - m :], 0)
    while True:
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(np.r_[0, sorted_key[1:] != sorted_key[:-1]])
        if rank[order[-1]] == n - 1 or step > left.max():
            break
        ahead = np.zeros(n, dtype=np.int64)
        if step < n:
            ahead[:-step] = np.where(string[step:] == string[:-step], rank[step:] + 1, 0)
        key = rank * (n + 2) + ahead
        step *= 2
    return order[left[order] > 0]


def _codes(text: np.ndarray, step: int) -> np.ndarray:
    """Small numbers in the order of the `step` symbols from each place on."""
    n, half = len(text), 5 if step == 10 else step
    codes = np.zeros(n, dtype=np.int64)
    for k in range(half):
        codes <<= 8
        codes[: max(0, n - k)] |= text[k:]
    codes = np.unique(codes, return_inverse=True)[1]
    if step == 10:
        codes = codes * n
        codes[: max(0, n - half)] += codes[half:] // n
        codes = np.unique(codes, return_inverse=True)[1]
    return codes.astype(np.int32)


def _stable_order(numbers: np.ndarray) -> np.ndarray:
    """Stable order of numbers below 2^31, by 16 bits at a time, which numpy sorts by radix."""
    order = np.argsort((numbers & 0xFFFF).astype(np.uint16), kind="stable")
    high = (numbers >> 16).astype(np.uint16)
    return order[np.argsort(high[order], kind="stable")] if high.any() else order


def merge(strings: list[bytes], shards: list[range], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All suffixes of the strings by their first `depth` symbols: places (in a layout
    with ends), blocks of those that agree so far, and how much is left of each string.

    Starts from the sorted shards one after the other. Round r knows the order by the
    first r steps of symbols; reading, along it, the step of symbols before every suffix
    (the transforms, interleaved) and sorting them stably gives the order by one step
    more. Neighbours stay in one block if these symbols and the blocks they come from
    are equal. Ends differ from each other and stay in front.
    """
    step = next(w for w in (10, 5, 4, 2, 1) if depth % w == 0)
    text, starts, stops = _layout(strings, step)
    n = len(text)
    place = np.arange(n, dtype=np.int32)
    before = place - np.int32(step)
    first = np.repeat(starts, stops - starts + step)
    before[before < first] = -1
    codes = _codes(text, step)
    ends = place[text == 0]
    m = len(ends)
    order = [ends]
    for shard in shards:
        local = suffix_order([strings[k] for k in shard])
        own = np.repeat(np.arange(len(shard)), [len(strings[k]) + 1 for k in shard])[local]
        order.append((local + own * (step - 1) + starts[shard.start]).astype(np.int32))
    order = np.concatenate(order)
    block = np.zeros(n, dtype=np.int32)
    for _ in range(depth // step):
        suffixes = before[order]
        inner = np.flatnonzero(suffixes >= 0)
        suffixes = suffixes[inner]
        read = codes[suffixes]
        by_read = _stable_order(read)
        suffixes, read, came = suffixes[by_read], read[by_read], block[inner[by_read]]
        fresh = np.ones(n - m, dtype=bool)
        fresh[1:] = (read[1:] != read[:-1]) | (came[1:] != came[:-1])
        order = np.concatenate([ends, suffixes])
        block = np.concatenate([place[:m], np.cumsum(fresh, dtype=np.int32) + np.int32(m - 1)])
        if block[-1] == n - 1:
            break
    left = np.repeat(stops, stops - starts + step) - place
    return order, block, left


def repeated_windows(strings: list[bytes], length: int = LENGTH, shard_bytes: int = SHARD_BYTES) -> list[np.ndarray]:
    """For each string, which of its `length`-byte windows also start earlier, in an
    earlier string or before in the same one."""
    shards, size, start = [], 0, 0
    for k, s in enumerate(strings):
        size += len(s)
        if size >= shard_bytes or k == len(strings) - 1:
            shards.append(range(start, k + 1))
            size, start = 0, k + 1
    order, block, left = merge(strings, shards, length)
    fits = left[order] >= length
    places, block = order[fits], block[fits]
    least = np.full(int(block.max()) + 1 if len(block) else 0, np.iinfo(np.int32).max, dtype=np.int32)
    np.minimum.at(least, block, places)
    again = np.zeros(len(left), dtype=bool)
    again[places] = places > least[block]
    pad = (len(left) - sum(map(len, strings))) // max(1, len(strings))
    ends = np.cumsum([len(s) + pad for s in strings])
    return [again[e - len(s) - pad :][: max(0, len(s) - length + 1)] for e, s in zip(ends, strings, strict=True)]


REMOVED = "doc_id long, text_hash long, start long, windows int"


def _merge_lot(table: pa.Table) -> pa.Table:
    """Step 3 for a lot: runs of windows that start earlier elsewhere."""
    unknown = table.column("doc_id").is_null().to_numpy()
    doc = table.column("doc_id").fill_null(0).to_numpy()
    text_hash, start = table.column("text_hash").to_numpy(), table.column("start").to_numpy()
    data = table.column("data").to_pylist()
    order = np.lexsort((start, text_hash, doc, unknown))
    new = np.ones(len(order), dtype=bool)
    new[1:] = False
    for c in (start, text_hash, doc, unknown):
        new[1:] |= c[order][1:] != c[order][:-1]
    order = order[new]
    first, last = shared_windows([data[k] for k in order])
    kept = last >= first
    order, first, last = order[kept], first[kept], last[kept]
    strings = [data[k][a : b + LENGTH] for k, a, b in zip(order, first, last, strict=True)]
    rows: list[tuple] = []
    for k, skipped, again in zip(order, first, repeated_windows(strings) if strings else [], strict=True):
        edges = np.flatnonzero(np.diff(np.r_[0, again.astype(np.int8), 0]))
        for a, b in edges.reshape(-1, 2):
            rows.append((None if unknown[k] else int(doc[k]), int(text_hash[k]), int(start[k] + skipped + a), int(b - a)))
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int32())
    columns = list(zip(*rows, strict=True)) or [()] * 4
    return pa.Table.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[f.split()[0] for f in REMOVED.split(", ")]
    )


# ---- on Spark ----------------------------------------------------------------------------


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col)
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.cast("binary").alias("data")
    )


def _crowded_anchors(keyed: DataFrame, texts: int) -> np.ndarray:
    """Anchors with MANY segments or more in a sample; as many as it has, by MANY, at most."""
    share, none = 1 << 24, np.zeros(0, dtype=np.int64)
    least = share if texts <= SAMPLE_TEXTS else max(1, share * SAMPLE_TEXTS // texts)
    sample = keyed.filter(F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(share)) < least)
    found = sample.mapInArrow(lambda batches: _emit(batches, none), SEGMENTS).filter(F.col("kind") == FOUND)
    anchors = found.groupBy("anchor").agg(F.countDistinct("bytes_hash").alias("n")).filter(F.col("n") >= MANY)
    return np.array(sorted(r["anchor"] for r in anchors.select("anchor").collect()), dtype=np.int64)


def repeated_ranges(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, ranges: start, end of repeated windows in bytes), unsorted,
    overlapping; a row for each text that has any."""
    keyed = _keyed(docs, id_col, text_col)
    size = keyed.agg(F.sum(F.length("data")).alias("bytes"), F.count(F.lit(1)).alias("texts")).first()
    buckets = max(1, -(-(size["bytes"] or 0) // BUCKET_BYTES))
    crowded = _crowded_anchors(keyed, size["texts"])
    found = keyed.mapInArrow(lambda batches: _emit(batches, crowded), SEGMENTS)
    # What is settled already only passes through, dealt evenly.
    key = F.when(F.col("kind") == FOUND, F.col("anchor")).otherwise(F.xxhash64("text_hash", "start"))
    found = found.withColumn("bucket", F.pmod(key, F.lit(buckets)))
    found = stored(found.groupBy("bucket").applyInArrow(_settle, SEGMENTS), "segments")
    settled = found.filter(F.col("kind") == SETTLED).select("doc_id", "text_hash", "start", "windows")
    asked = found.filter(F.col("kind") == ASKED)
    asked_bytes = asked.agg(F.sum(F.col("windows") + F.lit(LENGTH))).first()[0] or 0
    lots = max(1, -(-asked_bytes // LOT_BYTES))
    wanted = asked.groupBy("doc_id", "text_hash").agg(
        F.collect_set(F.struct("anchor", "start", "windows")).alias("wanted")
    )
    one = keyed.join(wanted.withColumnsRenamed({"doc_id": "w_id", "text_hash": "w_hash"}),
                     F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("text_hash") == F.col("w_hash")))
    one = one.select("doc_id", "text_hash", "data", F.explode("wanted").alias("w"))
    cut = F.substr(F.col("data"), (F.col("w.start") + 1).cast("int"), F.col("w.windows") + F.lit(LENGTH - 1))
    # Equal rows give equal segments; in a lot, one place of a text counts once.
    strings = one.select("doc_id", "text_hash", F.col("w.anchor").alias("anchor"), F.col("w.start").alias("start"), cut.alias("data"))
    strings = strings.withColumn("lot", F.pmod("anchor", F.lit(lots)))
    merged = strings.groupBy("lot").applyInArrow(_merge_lot, REMOVED)
    ranges = settled.unionByName(merged)
    span = F.struct("start", (F.col("start") + F.col("windows") + F.lit(LENGTH - 1)).alias("end"))
    return ranges.groupBy("doc_id", "text_hash").agg(F.collect_list(span).alias("ranges"))


def _runs(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges sorted and joined where they touch."""
    runs: list[list[int]] = []
    for start, end in sorted(ranges):
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([start, end])
    return [(a, b) for a, b in runs]


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept, binary) of every input row.

    Documents are ordered by id, nulls last, rows of one id by their text. Null and empty
    texts have no bytes, and texts shorter than a window lose none; of repeated rows all
    but one lose everything. Other columns are not looked at.
    """
    keyed = _keyed(docs, id_col, text_col)
    ranges = repeated_ranges(docs, id_col, text_col).withColumnsRenamed({"doc_id": "r_id", "text_hash": "r_hash"})
    joined = keyed.join(
        ranges, F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("text_hash") == F.col("r_hash")), "left"
    ).select("doc_id", "text_hash", "data", "ranges")
    schema = "doc_id long, text_hash long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    schema += ", kept binary" if with_text else ""

    def cut(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                rows = []
                for data, ranges in zip(part.column(2).to_pylist(), part.column(3), strict=True):
                    data = data or b""
                    runs = _runs([(r["start"], r["end"]) for r in ranges.as_py() or []])
                    edges = [0, *(x for run in runs for x in run), len(data)]
                    kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                    rows.append((len(data), len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept))
                n, removed, spans, sha, kept = zip(*rows, strict=True)
                columns = [part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(removed, pa.int64())]
                columns += [pa.array(spans, pa.int64()), pa.array(sha, pa.string())]
                columns += [pa.array(kept, pa.binary())] * with_text
                yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in schema.split(", ")])

    result = joined.mapInArrow(cut, schema)
    again = F.row_number().over(Window.partitionBy("doc_id", "text_hash").orderBy(F.lit(1))) > 1
    gone = F.col("again") & (F.col("n_bytes") >= LENGTH)
    result = result.withColumn("again", again)
    changed = {
        "n_removed": F.when(gone, F.col("n_bytes")).otherwise(F.col("n_removed")),
        "n_spans": F.when(gone, F.lit(1).cast("long")).otherwise(F.col("n_spans")),
        "kept_sha256": F.when(gone, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.col("kept_sha256")),
    }
    if with_text:
        changed["kept"] = F.when(gone, F.lit(b"")).otherwise(F.col("kept"))
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if with_text else [])]
    return result.withColumns(changed).select(*columns)
