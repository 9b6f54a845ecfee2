"""Near-duplicates by 64-bit SimHash fingerprints at most two bits apart.

Deletion-variant signatures: of two halves of 32 bits, one differs by at most one
bit, so both fingerprints share a variant of it in which one bit is wiped out. All
64 one-wildcard variants of every distinct fingerprint are indexed; equal variants
are candidates, and the whole fingerprints decide. Where more than CROWD distinct
fingerprints share a variant, theirs are indexed again with two bits wiped out of
all 64: at most four can share such a variant, so a crowd costs as much a
fingerprint as a few do, and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tillhouse.llm.components import least_reachable
from tillhouse.llm.shared import stored, unused

SHINGLE = 3
SEED = 42
CROWD = 128
#: Shingles whose bits are counted at once; bounds memory for very long texts.
AT_ONCE = 1 << 16

_hash = partial(xxhash.xxh64_intdigest, seed=SEED)


def fingerprint(text: str | None) -> int:
    """Signed 64-bit SimHash of a text's shingles; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles: Iterator[bytes] = iter([b" ".join(words)])
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(SHINGLE)), strict=False))
    total = max(1, len(words) - SHINGLE + 1)
    hashes = np.fromiter(map(_hash, shingles), dtype="<u8", count=total)
    counts = np.zeros(64, dtype=np.int64)
    for start in range(0, total, AT_ONCE):
        part = hashes[start : start + AT_ONCE].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > total, bitorder="little")
    return int(bits.view("<i8")[0])


@F.pandas_udf(T.LongType())
def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(t) for t in texts], dtype="int64")


def _prints(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text_hash, fp) of every row."""
    text = F.col(text_col)
    return docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), _fingerprints(text).alias("fp")
    )


def _bit(k: int) -> int:
    """1 << k as a signed long."""
    return (1 << k) - ((1 << 64) if k == 63 else 0)


def _near(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= 2


def _pairs(members: Column) -> Column:
    """Near pairs (u > v) of a short array of fingerprints."""
    return F.flatten(
        F.transform(
            members,
            lambda a: F.transform(
                F.filter(members, lambda b: (b < a) & _near(a, b)), lambda b: F.struct(a.alias("u"), b.alias("v"))
            ),
        )
    )


def near_links(fps: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(u, v), u > v: all links between distinct non-null fingerprints `fp`."""
    half = (1 << 32) - 1
    variants = []
    for k in range(64):
        kept = (half << (k // 32 * 32)) & ~(1 << k)
        kept -= (1 << 64) if kept >> 63 else 0
        variants.append(F.struct(F.lit(k).alias("wiped"), F.col("fp").bitwiseAND(F.lit(kept)).alias("rest")))
    index = fps.select("fp", F.explode(F.array(*variants)).alias("x")).select("x.*", "fp").repartition("wiped", "rest")
    sizes = index.groupBy("wiped", "rest").agg(
        F.count(F.lit(1)).alias("n"), F.min("fp").alias("lo"), F.max("fp").alias("hi")
    )
    sizes = sizes.filter("n > 1")
    twos = sizes.filter("n = 2").select(F.col("hi").alias("u"), F.col("lo").alias("v")).filter(_near(F.col("u"), F.col("v")))
    more = index.join(sizes.filter("n > 2").select("wiped", "rest", "n"), ["wiped", "rest"])
    few = (
        more.filter(F.col("n") <= crowd)
        .groupBy("wiped", "rest")
        .agg(F.collect_list("fp").alias("members"))
        .select(F.explode(_pairs(F.col("members"))).alias("p"))
        .select("p.*")
    )
    crowded = more.filter(F.col("n") > crowd).select("fp").distinct()
    wipes = F.explode(
        F.array(*[F.lit(_bit(i) | _bit(j)) for i in range(64) for j in range(i)])
    )
    many = (
        crowded.select("fp", wipes.alias("wiped"))
        .groupBy("wiped", F.col("fp").bitwiseAND(F.bitwise_not("wiped")).alias("rest"))
        .agg(F.collect_list("fp").alias("members"))
        .filter(F.size("members") > 1)
        .select(F.explode(_pairs(F.col("members"))).alias("p"))
        .select("p.*")
    )
    return twos.unionByName(few).unionByName(many)


def _classes(prints: DataFrame) -> DataFrame:
    """(fp, first): the first row (by id, nulls last, then text hash) of its component."""
    row = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_hash")
    nodes = stored(prints.groupBy("fp").agg(F.min(row).alias("first")), "fingerprints")
    roots = least_reachable(near_links(nodes.select("fp")))
    named = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    firsts = named.groupBy("root").agg(F.min("first").alias("first"))
    return named.select("fp", "root").join(firsts, "root").select("fp", "first")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (hex), component_id of every input row.

    A text without words (null or empty) has fingerprint zero and links like any
    other. Rows with one id are nodes of their own; null ids take part but name no
    component unless all of its ids are null. Other columns are not looked at.
    """
    prints = stored(_prints(docs, id_col, text_col), "prints")
    of = _classes(prints).select("fp", F.col("first.doc_id").alias("component_id"))
    return prints.join(of, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, one of each component: that with the least id, nulls last.

    All columns stay, whatever their names; of repeated rows one is left.
    """
    prints = stored(_prints(docs, id_col, text_col), "prints")
    firsts = _classes(prints).select("first.*").distinct()
    this, that, known, number = unused(docs, "id", "hash", "text_hash", "number")
    firsts = firsts.select(F.col("doc_id").alias(this), F.col("text_hash").alias(that))
    rows = docs.withColumn(known, F.xxhash64(F.col(text_col)))
    kept = rows.join(
        firsts, rows[id_col].eqNullSafe(firsts[this]) & (rows[known] == firsts[that]), "left_semi"
    )
    order = Window.partitionBy(id_col, known).orderBy(F.lit(1))
    return kept.withColumn(number, F.row_number().over(order)).filter(F.col(number) == 1).select(*docs.columns)
