"""Vector best-fit packing of tokenised documents into sequences.

A sequence has three capacities: tokens, documents and attention cost (the sum of
squared piece lengths). Pieces go, longest first, into the sequence that has room
in every one of them and is left with the smallest weighted residual (or has the
largest weighted dot product of residual and demand). Pieces are dealt by hash into
lots of about LOT pieces, each packed by one task, so no task grows with the input;
a lot wastes less than one sequence more than one large lot would.
"""

from __future__ import annotations

import functools
import os
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.llm.shared import stored

END = 0
LOT = 16_384
#: Words whose ids a Python worker remembers for sure; twice as many at most.
REMEMBERED = 700_000
#: The same between other operators, as idle workers keep them: some 100 MB at most.
#: Beyond 349,525 entries a dictionary takes twice the room.
REMEMBERED_BESIDE_OTHERS = 340_000
#: Bytes of the longest words that are remembered.
LONGEST = 64


@dataclass(frozen=True)
class Capacity:
    """Of a sequence. The default documents and cost never bind before the tokens."""

    tokens: int = 2048
    documents: int = 2048
    cost: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 0.01, 0.1)
    by: str = "residual"  # or "dot"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@functools.cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


_recent: dict[bytes, bytes] = {}
_older: dict[bytes, bytes] = {}


def encode(texts: list[str | None], path: str, remembered: int | None = None) -> Iterator[bytes]:
    """Ids of each text and END, as little-endian unsigned 32-bit integers.

    The tokenizer never joins what white space (space, tab to carriage return) parts
    and turns all letters small, so ids of words follow each other as those of the
    text do. Words seen before are looked up; those not met for long are forgotten, and
    long ones at once. A worker uses one tokenizer at a time.
    """
    global _recent, _older
    tokenizer = _tokenizer(path)
    end = np.uint32(END).tobytes()
    if _recent.get(b"") != path.encode():
        _recent, _older = {b"": path.encode()}, {}
    for text in texts:
        data = (text or "").encode()
        words = data.split() if b"<|" in data else data.lower().split()  # special tokens have a case
        new = []
        for w in set(words).difference(_recent):
            ids = _older.get(w)
            if ids is None:
                new.append(w)
            else:
                _recent[w] = ids
        for start in range(0, len(new), 4096):
            part = new[start : start + 4096]
            encoded = tokenizer.encode_batch_fast([w.decode() for w in part], add_special_tokens=False)
            for w, e in zip(part, encoded, strict=True):
                _recent[w] = array("I", e.ids).tobytes()
        yield b"".join(map(_recent.__getitem__, words)) + end
        for w in new:
            if len(w) > LONGEST:
                del _recent[w]
        if len(_recent) > (remembered or REMEMBERED):
            _recent, _older = {b"": path.encode()}, _recent


def _pieces(docs: DataFrame, id_col: str, text_col: str, path: str, most: int, with_ids: bool, remembered: int | None) -> DataFrame:
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType(
        [T.StructField("doc_id", id_type), T.StructField("piece", T.IntegerType())]
        + [T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32")]
        + [T.StructField("ids", T.BinaryType())] * with_ids
    )

    def cut(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                rows: list[tuple] = []
                for k, ids in enumerate(encode(part.column(1).to_pylist(), path, remembered)):
                    n = len(ids) // 4
                    for piece, start in enumerate(range(0, n, most)):
                        own = ids[4 * start : 4 * (start + most)]
                        rows.append((k, piece, start, len(own) // 4, zlib.crc32(own), own))
                at, piece, start, length, crc, own = zip(*rows, strict=True)
                columns = [part.column(0).take(pa.array(at)), pa.array(piece, pa.int32())]
                columns += [pa.array(x, pa.int64()) for x in (start, length, crc)]
                columns += [pa.array(own, pa.binary())] * with_ids
                yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return docs.mapInArrow(cut, schema)


def best_fit(lengths: np.ndarray, capacity: Capacity = Capacity()) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece (lengths from 1 to the capacity)."""
    n = len(lengths)
    full = np.array([capacity.tokens, capacity.documents, capacity.cost], dtype=np.float64)
    weights = np.array(capacity.weights) / (full if capacity.by == "residual" else full**2)
    room = np.empty((3, n))
    names = np.empty(n, dtype=np.int64)
    sequence, offset = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    order = np.argsort(-lengths, kind="stable")
    least = int(lengths[order[-1]]) if n else 0
    is_open = made = 0
    for turn, k in enumerate(order):
        size = int(lengths[k])
        need = np.array([size, 1, size * size], dtype=np.float64)
        left = room[:, :is_open]
        fits = np.flatnonzero((left[0] >= size) & (left[1] >= 1) & (left[2] >= need[2]))
        if len(fits):
            if capacity.by == "residual":
                value = (((left[:, fits] - need[:, None]) * weights[:, None]) ** 2).sum(axis=0)
                b = fits[np.argmin(value)]
            else:
                b = fits[np.argmax((need * weights) @ left[:, fits])]
        else:
            if size > capacity.tokens or need[2] > capacity.cost or capacity.documents < 1:
                raise ValueError(f"a piece of {size} tokens fits no sequence")
            b, is_open = is_open, is_open + 1
            room[:, b], names[b] = full, made
            made += 1
        sequence[k], offset[k] = names[b], full[0] - room[0, b]
        room[:, b] -= need
        if turn % 64 == 63:  # forget sequences that no later piece fits into
            keep = np.flatnonzero((room[0, :is_open] >= least) & (room[1, :is_open] >= 1))
            room[:, : len(keep)], names[: len(keep)] = room[:, keep], names[keep]
            is_open = len(keep)
    return sequence, offset


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    capacity: Capacity = Capacity(),
    with_ids: bool = False,
    lot: int = LOT,
    remembered: int | None = None,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ids), sequence_id, offset.

    A null text counts as empty: one piece that holds END alone. Repeated rows and
    null ids are documents of their own. Only documents of more tokens than a
    sequence has are cut. Other columns are not looked at.
    """
    most = capacity.tokens
    pieces = stored(_pieces(docs, id_col, text_col, tokenizer or default_tokenizer(), most, with_ids, remembered), "pieces")
    lots = max(1, -(-pieces.count() // lot))
    key = F.pmod(F.xxhash64("doc_id", "piece", "length", "ids_crc32"), F.lit(lots))
    schema = T.StructType(
        [f for f in pieces.schema.fields]
        + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )

    def place(table: pa.Table) -> pa.Table:
        number = table.column("lot")[0].as_py()
        sequence, offset = best_fit(table.column("length").to_numpy(), capacity)
        table = table.drop_columns(["lot"])
        table = table.append_column("sequence_id", pa.array((number << 32) + sequence))
        return table.append_column("offset", pa.array(offset))

    return pieces.withColumn("lot", key).groupBy("lot").applyInArrow(place, schema)
