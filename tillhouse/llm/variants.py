"""Groups of spelling variants: words one edit apart, found by PartEnum signatures.

A word's letters are a multiset: a binary vector with one place for each letter and
number of its occurrence. One inserted or deleted letter changes one place, a replaced
one two, so near words have vectors at a Hamming distance of two at most. PartEnum
deals the places into PARTS parts and these into PIECES pieces; of two near vectors,
some part differs in few pieces, and what is left of it is the same. Every way to leave
so many pieces out is a signature. Words that share a signature are candidates, and the
edit distance decides.

Where more than CROWD words share a signature, those are matched by the signature
together with the first, and again with the last, HALF letters: an edit of a word of at
least MIN_LETTERS letters leaves one of them whole. Where that still brings more than
BIG_CROWD words together, the word with one letter wiped out is added to the key, which
at most a few letters' worth of words share. So no pair is lost, and none of the joins
grows with the square of a crowd.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tillhouse.llm.shared import stored, text_or_empty

LETTER = "[A-Za-zÀ-ÿ]"
MIN_LETTERS = 6
MIN_COUNT = 5
#: A near word is the form of another if it is at least so many times as frequent.
MORE_FREQUENT = 5
#: A letter is deleted where the checksum of `<id>:<run>` divides by this.
TYPO_EVERY = 199

DISTANCE = 2
PARTS = 1
PIECES = 7
HALF = MIN_LETTERS // 2
CROWD = 16
BIG_CROWD = 256
#: Frequencies below 2 ** 63 allow chains of fewer than 28 forms; five doublings pass 32.
MAX_ROUNDS = 6


# ---- words and counts ----------------------------------------------------------------


def _lower_ascii(word: Column) -> Column:
    """A-Z in lower case; other letters stay as they are."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    plain = F.length(word) == F.octet_length(word)
    return F.when(plain, F.lower(word)).otherwise(F.translate(word, upper, upper.lower()))


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): words of all texts, at least MIN_LETTERS long, that occur MIN_COUNT times.

    Shorter runs cannot become words of that length, so they are not looked at. A null
    id counts as an empty one. Occurrences are summed in every task before they travel.
    """
    runs = F.regexp_extract_all(text_or_empty(text_col), F.lit(f"({LETTER}{{{MIN_LETTERS},}})"), F.lit(1))
    own = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    found = docs.select(own.alias("id"), F.explode(runs).alias("run")).select("id", _lower_ascii(F.col("run")).alias("run"))
    found = found.withColumn("h", F.crc32(F.concat_ws(":", "id", "run")))
    at = F.col("h") % F.length("run")
    wiped = F.concat(F.substring(F.col("run"), F.lit(1), at.cast("int")), F.substring(F.col("run"), (at + 2).cast("int"), F.length("run")))
    word = F.when(F.col("h") % TYPO_EVERY == 0, wiped).otherwise(F.col("run"))
    counts = found.select(word.alias("word")).filter(F.length("word") >= MIN_LETTERS).groupBy("word")
    return counts.agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= MIN_COUNT)


# ---- signatures ------------------------------------------------------------------------


def _mixed(x: np.ndarray) -> np.ndarray:
    """Well-spread 64-bit numbers from unsigned 64-bit ones."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signatures(words: list[str], parts: int = PARTS, pieces: int = PIECES, distance: int = DISTANCE) -> np.ndarray:
    """A row of signed 64-bit signatures for each word.

    Multisets of letters that differ in `distance` places at most share a signature.
    A signature is a sum of random numbers of the places that it covers.
    """
    left_out = -(-(distance + 1) // parts) - 1
    if not 0 <= left_out < pieces:
        raise ValueError("a part needs more pieces than may differ")
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    word = np.repeat(np.arange(len(words)), lengths)
    order = np.lexsort((letters, word))
    word, letters = word[order], letters[order]
    new = np.r_[True, (word[1:] != word[:-1]) | (letters[1:] != letters[:-1])][: len(word)]
    place = np.arange(len(word))
    nth = place - np.maximum.accumulate(np.where(new, place, 0))
    value = _mixed((nth.astype(np.uint64) << np.uint64(32)) + letters.astype(np.uint64) + np.uint64(1))
    cell = (value % np.uint64(parts * pieces)).astype(np.int64)
    sums = np.zeros(len(words) * parts * pieces, dtype=np.uint64)
    np.add.at(sums, word * (parts * pieces) + cell, _mixed(value + np.uint64(0x9E3779B97F4A7C15)))
    sums = sums.reshape(len(words), parts, pieces)
    found = []
    for part in range(parts):
        whole = sums[:, part].sum(axis=1, dtype=np.uint64)
        for gone in combinations(range(pieces), left_out):
            rest = whole - sums[:, part, list(gone)].sum(axis=1, dtype=np.uint64)
            found.append(_mixed(rest + np.uint64((len(found) + 1) * 0xD1B54A32D192ED03 % (1 << 64))))
    return np.stack(found, axis=1).view(np.int64) if words else np.zeros((0, 1), dtype=np.int64)


def _with_signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = signatures(batch.column("word").to_pylist())
        offsets = np.arange(len(found) + 1, dtype=np.int32) * found.shape[1]
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.ravel()))
        yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), lists], names=["word", "n", "signatures"])


# ---- near words --------------------------------------------------------------------------


def _near(a: Column, b: Column) -> Column:
    return F.levenshtein(a, b, 1) == 1


def _pairs_of(members: Column) -> Column:
    """Near pairs of a short array of (word, n)."""
    return F.flatten(
        F.transform(
            members,
            lambda a: F.transform(
                F.filter(members, lambda b: (b["word"] < a["word"]) & _near(a["word"], b["word"])),
                lambda b: F.struct(a.alias("u"), b.alias("v")),
            ),
        )
    )


def _joined(index: DataFrame, keys: list[str]) -> DataFrame:
    """Near pairs of rows with equal keys."""
    u = index.select(*keys, F.struct("word", "n").alias("u"))
    v = index.select(*keys, F.struct("word", "n").alias("v"))
    near = (F.col("v.word") < F.col("u.word")) & _near(F.col("u.word"), F.col("v.word"))
    return u.join(v, keys).filter(near).select("u", "v")


def near_pairs(words: DataFrame, crowd: int = CROWD, big_crowd: int = BIG_CROWD) -> DataFrame:
    """(u, v): distinct pairs of near words, each a struct of word and n; `words` has one
    row per word, and MIN_LETTERS letters at least in each."""
    schema = T.StructType([*words.select("word", "n").schema.fields, T.StructField("signatures", T.ArrayType(T.LongType()))])
    index = words.select("word", "n").mapInArrow(_with_signatures, schema)
    index = index.select(F.explode("signatures").alias("key"), "word", "n")
    index = stored(index.withColumn("members", F.count(F.lit(1)).over(Window.partitionBy("key"))).filter("members > 1"), "signatures")
    few = index.filter(F.col("members") <= crowd).groupBy("key").agg(F.collect_list(F.struct("word", "n")).alias("all"))
    pairs = few.select(F.explode(_pairs_of(F.col("all"))).alias("p")).select("p.*")

    halves = F.array(
        F.concat(F.lit("<"), F.substring("word", 1, HALF)), F.concat(F.lit(">"), F.substring("word", -HALF, HALF))
    )
    halved = index.filter(F.col("members") > crowd).select("key", F.explode(halves).alias("half"), "word", "n")
    halved = halved.withColumn("members", F.count(F.lit(1)).over(Window.partitionBy("key", "half")))
    halved = stored(halved.filter("members > 1"), "halves")
    pairs = pairs.unionByName(_joined(halved.filter(F.col("members") <= big_crowd), ["key", "half"]))

    big = halved.filter(F.col("members") > big_crowd).select("word", "n").distinct()
    at = F.explode(F.sequence(F.lit(0), F.length("word"))).alias("at")  # 0: the word itself
    wiped = F.when(F.col("at") == 0, F.col("word")).otherwise(
        F.concat(F.substring(F.col("word"), F.lit(1), F.col("at") - 1), F.substring(F.col("word"), F.col("at") + 1, F.length("word")))
    )
    big = big.select("word", "n", at).select(wiped.alias("wiped"), "word", "n").distinct()
    pairs = pairs.unionByName(_joined(big, ["wiped"]))
    return pairs.distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words that have a form: pointers that skip twice as far each round."""
    jumps = stored(forms.select("word", F.col("form").alias("root")), "forms")
    for _ in range(MAX_ROUNDS):
        further = jumps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumps = stored(
            jumps.join(further, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            ),
            "forms",
        )
        if jumps.filter("moved").isEmpty():
            break
        jumps = jumps.select("word", "root")
    return jumps.select("word", "root")


def spelling_variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", crowd: int = CROWD, big_crowd: int = BIG_CROWD
) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the texts.

    Null and empty texts have no words; rows with one id, or repeated rows, count one by
    one. Of near words equally frequent the one first in code-point order is the form.
    A word without a near word has n_near 0; without a form, form and form_n are null and
    the root is the word itself. Other columns are not looked at.
    """
    words = stored(word_counts(docs, id_col, text_col), "words")
    pairs = near_pairs(words, crowd, big_crowd)
    both = F.explode(F.array(F.struct(F.col("u").alias("a"), F.col("v").alias("b")), F.struct(F.col("v").alias("a"), F.col("u").alias("b"))))
    sides = pairs.select(both.alias("p")).select("p.a.word", F.col("p.a.n").alias("own"), F.col("p.b.word").alias("other"), F.col("p.b.n").alias("more"))
    near = sides.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("more")).alias("less"), "other")).alias("best")
    )
    near = near.select("word", "n_near", F.col("best.other").alias("other"), (-F.col("best.less")).alias("more"))
    has = F.col("more") >= MORE_FREQUENT * F.col("n")
    known = words.join(near, "word", "left").select(
        "word",
        F.when(has, F.col("other")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has, F.col("more")).alias("form_n"),
    )
    known = stored(known, "near-words")
    roots = _roots(known.filter("form is not null"))
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
