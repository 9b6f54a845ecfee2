"""Language-model scores of documents: stupid backoff over counts of the whole corpus.

Documents are dealt by hash into batches. A batch asks for the counts of its distinct
n-grams, hashed and sorted, in slices by hash; a slice's count table sums what all
batches have and is joined back to each; the batch then scores its documents and sums
their logarithms. An n-gram that is everywhere travels once per batch, so there is no
hot key, and no task sees more than a slice of the counts or a batch of the texts.
Texts, hashes (as steps from one to the next) and counts travel compressed.

Every document is scored by the counts of all others: its own are taken off first.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.llm.shared import WORD, stored, text_or_empty

ORDER = 3
BACKOFF = 0.4
BATCH_BYTES = 8 << 20
#: Words of the corpus for a slice of the counts of one order.
SLICE_WORDS = 2_000_000

ASKED = "batch int, slice int, n int, hashes binary, counts binary"
ANSWER = "batch int, slice int, n int, totals binary"

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _words(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (ASCII letters small) of all texts in a row, and how many each has."""
    known, parts = _Hashes(), []
    for text in texts:
        words = (text or b"").lower().split()
        parts.append(np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words)))
    lengths = np.array([len(p) for p in parts], dtype=np.int64)
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64), lengths


def _texts(table: pa.Table) -> list[bytes]:
    """The texts of a batch as they were before `small`."""
    pairs = zip(table.column("data").to_pylist(), table.column("n_bytes").to_pylist(), strict=True)
    return [pa.decompress(x, decompressed_size=n, codec="zstd", asbytes=True) if n else b"" for x, n in pairs]


def _ngrams(words: np.ndarray, lengths: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the n-gram that ends at each place, and whether there is one in its text."""
    h = words.copy()
    for k in range(1, n):
        before = h[:-1] * _A
        before ^= before >> np.uint64(29)
        h = np.concatenate([h[:1], (before * _B + words[1:]) * _A])
        h ^= h >> np.uint64(32)
    place = np.arange(len(words)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return h, place >= n - 1


def _packed(values: np.ndarray) -> bytes:
    """How many integers, the sizes of their planes, then all lowest bytes, all second ones ...
    Each plane is compressed by itself, as those above the random ones cost next to nothing."""
    planes = values.view(np.uint8).reshape(len(values), -1).T
    parts = [pa.compress(np.ascontiguousarray(x), codec="zstd", asbytes=True) for x in planes]
    return b"".join([np.array([len(values), *map(len, parts)], dtype="<u4").tobytes(), *parts])


def _unpacked(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    number, *lengths = np.frombuffer(data, dtype="<u4", count=size + 1).tolist()
    out, at = np.empty((number, size), dtype=np.uint8), 4 * (size + 1)
    for k, n in enumerate(lengths):
        plane = pa.decompress(data[at : at + n], decompressed_size=number, codec="zstd")
        out[:, k] = np.frombuffer(plane, dtype=np.uint8)
        at += n
    return out.view(kind).ravel()


def _steps(hashes: np.ndarray) -> np.ndarray:
    """Sorted hashes as the first of them and what each is above the one before."""
    return np.diff(hashes, prepend=np.uint64(0)).astype("<u8")


def _slice_of(hashes: np.ndarray, slices: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(slices) >> np.uint64(32)).astype(np.int64)


def score(words: np.ndarray, lengths: np.ndarray, totals: list[dict], corpus_words: int) -> dict[str, np.ndarray]:
    """Per text: sum of log scores and words scored by less than the full order.

    totals[n - 1] has the sorted distinct hashes of n-grams and their corpus counts.
    """
    text = np.repeat(np.arange(len(lengths)), lengths)
    others = np.maximum(corpus_words - lengths, 1).astype(np.float64)[text]
    result = np.full(len(words), np.nan)
    below: np.ndarray | None = None  # counts of the n-gram one shorter that ends at each place
    for n, t in enumerate(totals, 1):
        h, there = _ngrams(words, lengths, n)
        at = np.searchsorted(t["hashes"], h)
        at[~there] = 0
        pair = at * len(lengths) + text  # (n-gram, text)
        _, inverse, own = np.unique(pair[there], return_inverse=True, return_counts=True)
        left = np.zeros(len(words))
        left[there] = t["counts"][at[there]] - own[inverse]
        if n == 1:
            # Words that no other document has count as one among all.
            value = np.log(np.where(left > 0, left, BACKOFF) / others)
            used = np.ones(len(words), dtype=np.int64)
        else:
            context = np.concatenate([[0.0], below[:-1]])
            seen = there & (left > 0)
            value = result + np.where(there, np.log(BACKOFF), 0.0)
            value[seen] = np.log(left[seen] / context[seen])
            used[seen] = n
        result, below = value, left
    full = np.minimum(np.arange(len(words)) - (np.cumsum(lengths) - lengths)[text] + 1, len(totals))
    return {
        "log_score": np.bincount(text, result, minlength=len(lengths)).astype(float),  # whole numbers without any word
        "n_backed_off": np.bincount(text, used < full, minlength=len(lengths)).astype(np.int64),
    }


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER) -> DataFrame:
    """doc_id, n_words, n_backed_off, log_score, mean_log_score of every input row.

    A text without words (null or empty) has score 0 and no mean. Repeated rows and
    null ids are documents of their own, and count for each other. Other columns are
    not looked at.
    """
    text = text_or_empty(text_col)
    keyed = docs.select(F.col(id_col).alias("doc_id"), text.cast("binary").alias("data"))
    size = docs.agg(
        F.sum(F.octet_length(text)).alias("bytes"), F.sum(F.regexp_count(text, F.lit(WORD)).cast("long")).alias("words")
    ).first()
    corpus_words = int(size["words"] or 0)
    batches = max(1, -(-int(size["bytes"] or 0) // BATCH_BYTES))
    slices = max(1, -(-corpus_words // SLICE_WORDS))
    keyed = keyed.withColumn("batch", F.pmod(F.xxhash64("doc_id", "data"), F.lit(batches)).cast("int"))

    def small(parts):
        for part in parts:
            data = [pa.compress(x, codec="zstd", asbytes=True) if x else b"" for x in part.column("data").to_pylist()]
            n_bytes = pc.binary_length(part.column("data")).cast(pa.int64())
            columns = [part.column("doc_id"), pa.array(data, pa.binary()), n_bytes, part.column("batch")]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "data", "n_bytes", "batch"])

    sent = T.StructType(
        [keyed.schema["doc_id"], T.StructField("data", T.BinaryType()), T.StructField("n_bytes", T.LongType()),
         T.StructField("batch", T.IntegerType())]
    )
    keyed = keyed.mapInArrow(small, sent)

    def ask(table: pa.Table) -> pa.Table:
        words, lengths = _words(_texts(table))
        rows = []
        for n in range(1, order + 1):
            h, there = _ngrams(words, lengths, n)
            hashes, counts = np.unique(h[there], return_counts=True)
            counts = counts.astype("<u4")
            ends = np.searchsorted(_slice_of(hashes, slices), np.arange(slices), side="right")
            for k, (a, b) in enumerate(zip(np.r_[0, ends[:-1]], ends, strict=True)):
                if b > a:
                    rows.append((k, n, _packed(_steps(hashes[a:b])), _packed(counts[a:b])))
        columns = list(zip(*rows, strict=True)) or [()] * 4
        batch = [table.column("batch")[0].as_py()] * len(rows)
        types = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
        arrays = [pa.array(batch, pa.int32())] + [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        return pa.Table.from_arrays(arrays, names=["batch", "slice", "n", "hashes", "counts"])

    def answer(table: pa.Table) -> pa.Table:
        hashes = [np.cumsum(_unpacked(x, "<u8"), dtype=np.uint64) for x in table.column("hashes").to_pylist()]
        counts = np.concatenate([_unpacked(x, "<u4") for x in table.column("counts").to_pylist()])
        ends = np.cumsum([len(x) for x in hashes])
        _, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
        totals = np.bincount(inverse, counts)[inverse].astype("<u8")
        own = [_packed(x) for x in np.split(totals, ends[:-1])]
        return table.select(["batch", "slice", "n"]).append_column("totals", pa.array(own, pa.binary()))

    schema = T.StructType(
        [keyed.schema["doc_id"], T.StructField("n_words", T.LongType()), T.StructField("n_backed_off", T.LongType()),
         T.StructField("log_score", T.DoubleType()), T.StructField("mean_log_score", T.DoubleType())]
    )

    def finish(texts: pa.Table, answers: pa.Table) -> pa.Table:
        words, lengths = _words(_texts(texts))
        given = sorted(answers.select(["n", "slice", "totals"]).to_pylist(), key=lambda r: (r["n"], r["slice"]))
        totals = []
        for n in range(1, order + 1):
            h, there = _ngrams(words, lengths, n)
            parts = [_unpacked(r["totals"], "<u8") for r in given if r["n"] == n]
            totals.append({"hashes": np.unique(h[there]), "counts": np.concatenate([np.zeros(0, "<u8"), *parts]).astype(float)})
        found = score(words, lengths, totals, corpus_words)
        mean = pa.array(found["log_score"] / np.maximum(lengths, 1), mask=lengths == 0)
        columns = [texts.column("doc_id"), pa.array(lengths), pa.array(found["n_backed_off"]), pa.array(found["log_score"]), mean]
        return pa.Table.from_arrays(columns, names=schema.fieldNames())

    asked = keyed.groupBy("batch").applyInArrow(ask, ASKED)
    answers = asked.groupBy("slice", "n").applyInArrow(answer, ANSWER)
    return keyed.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(finish, schema)


def relational_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER) -> DataFrame:
    """The same rows as `lm_scores`, by joins alone: n-grams exploded, once per document
    with how often it has them; a count table by hash; both joined, where adaptive planning
    splits the most frequent n-grams; and summed per document.

    Each n-gram of each document is a row of three exchanges, which is why the query
    takes the other form; see the README for what this one needs.
    """
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), text.cast("binary").alias("data"))
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "rows")

    def explode(parts):
        for part in parts:
            for row, data in zip(part.column("row").to_pylist(), part.column("data").to_pylist(), strict=True):
                words, lengths = _words([data])
                for n in range(1, order + 1):
                    h, there = _ngrams(words, lengths, n)
                    hashes, own = np.unique(h[there], return_counts=True)
                    columns = [pa.repeat(pa.scalar(row), len(hashes)), pa.repeat(pa.scalar(n, pa.int32()), len(hashes))]
                    columns += [pa.array(hashes.view(np.int64)), pa.array(own)]
                    yield pa.RecordBatch.from_arrays(columns, names=["row", "n", "hash", "own"])

    grams = rows.select("row", "data").mapInArrow(explode, "row long, n int, hash long, own long")
    counts = grams.groupBy("n", "hash").agg(F.sum("own").alias("total"))
    known = grams.join(counts, ["n", "hash"]).select("row", "n", "hash", "total")
    corpus_words = int(docs.agg(F.sum(F.regexp_count(text, F.lit(WORD)).cast("long"))).first()[0] or 0)
    schema = T.StructType(
        [rows.schema["doc_id"], T.StructField("n_words", T.LongType()), T.StructField("n_backed_off", T.LongType()),
         T.StructField("log_score", T.DoubleType()), T.StructField("mean_log_score", T.DoubleType())]
    )

    def sum_up(own: pa.Table, given: pa.Table) -> pa.Table:
        words, lengths = _words(own.column("data").to_pylist())
        of, hashes = given.column("n").to_numpy(), given.column("hash").to_numpy().view(np.uint64)
        totals = []
        for n in range(1, order + 1):
            at = np.flatnonzero(of == n)
            at = at[np.argsort(hashes[at])]
            totals.append({"hashes": hashes[at], "counts": given.column("total").to_numpy()[at].astype(float)})
        found = score(words, lengths, totals, corpus_words)
        mean = pa.array(found["log_score"] / np.maximum(lengths, 1), mask=lengths == 0)
        columns = [own.column("doc_id"), pa.array(lengths), pa.array(found["n_backed_off"]), pa.array(found["log_score"]), mean]
        return pa.Table.from_arrays(columns, names=schema.fieldNames())

    return rows.groupBy("row").cogroup(known.groupBy("row")).applyInArrow(sum_up, schema)
