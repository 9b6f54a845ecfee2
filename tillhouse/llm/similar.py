"""Near copies: texts whose five-word shingles have a Jaccard similarity of 0.8 or more.

Candidates come from SimHash and deletion-variant signatures. The fingerprint is cut
into SEGMENTS of WIDTH bits; of two near copies, some segment nearly surely differs in
one bit at most, and then both share a variant of it in which one bit is wiped out. All
one-wildcard variants of every distinct fingerprint are matched by equality: one half of
the segment stays whole, so segments are dealt by each half, and the variants of the other
are made where they arrive. Pairs whose whole fingerprints are too far apart go, and the
shingles of the others decide. Fingerprints count distinct shingles, as these sets do: a
sentence weighs the same however often it occurs.

Sets of sizes too far apart cannot be similar; a variant's fingerprints are parted where
their sizes have such a gap. Each fingerprint is compared first with one partner, the one
that shares most of all that share a variant with it, and what this connects is a class
from then on. Only members of different classes are compared further: pair by pair where a
variant has CROWD fingerprints at most, and where it has more, those whose sets can still
overlap enough by their rarest common shingle (prefix filter). Both are exact, and neither
grows with the square of a crowd whose members resemble one text, or nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tillhouse.llm.components import least_reachable
from tillhouse.llm.shared import stored, unused

SHINGLE = 5
SIMILARITY = 0.8
#: The fingerprint: of distinct three-word shingles, whose distances are smaller than those of five.
FEATURE = 3
#: Of scattered edits that leave a similarity of 0.8, a bit differs with 0.117, and all
#: segments in two bits or more with 0.0005.
SEGMENTS = 32
WIDTH = 24
HALF = WIDTH // 2
#: Differing bits beyond which no shingles are compared; pairs at 0.8 have about 90 of 768
#: (116 if three-word shingles differ as much as those of five), unrelated ones about 384.
FAR = 230
CROWD = 8
AT_ONCE = 1 << 13  # fewer than an unsigned 16-bit sum can hold
#: Rows of a batch that a worker turns into Python objects together.
SLICE = 256
#: Classes of set sizes: so many for a factor of e.
SIZE_CLASSES = 16
#: What sums of fractions may be off.
EPSILON = 1e-6
#: Segments that a group of those dealt by their halves has, about.
GROUP = 1 << 15

_feature = partial(xxhash.xxh64_intdigest, seed=42)
_shingle = partial(xxhash.xxh32_intdigest, seed=42)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _grams(words: list[bytes], n: int):
    if len(words) < n:
        return iter([b" ".join(words)]) if words else iter([])
    return map(b" ".join, zip(*(words[k:] for k in range(n)), strict=False))


def _more_bits(h: np.ndarray) -> np.ndarray:
    """SEGMENTS * WIDTH bits for each 64-bit hash, a row of bytes each."""
    number = -(-SEGMENTS * WIDTH // 64)
    out = np.empty((len(h), number), dtype="<u8")
    for k in range(number):
        x = h + np.uint64(int(_STEP) * k % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        out[:, k] = x ^ (x >> np.uint64(31))
    return out.view(np.uint8)[:, : SEGMENTS * WIDTH // 8]


def segments(text: str | None) -> list[int]:
    """The segments of a text's fingerprint; all zero without words."""
    words = _words(text)
    hashes = np.unique(np.fromiter(map(_feature, _grams(words, FEATURE)), dtype="<u8"))
    total = len(hashes)
    counts = np.zeros(SEGMENTS * WIDTH, dtype=np.int64)
    for start in range(0, total, AT_ONCE):
        bits = np.unpackbits(_more_bits(hashes[start : start + AT_ONCE]), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint16)
    return ((2 * counts > total).reshape(SEGMENTS, WIDTH) @ (1 << np.arange(WIDTH))).tolist()


def shingles(text: str | None) -> bytes:
    """Sorted distinct 32-bit hashes of the shingles of a text."""
    return np.unique(np.fromiter(map(_shingle, _grams(_words(text), SHINGLE)), dtype="<u4")).tobytes()


def jaccard(a: bytes, b: bytes) -> float:
    x, y = np.frombuffer(a, dtype="<u4"), np.frombuffer(b, dtype="<u4")
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both) if len(x) + len(y) else 1.0


def _by_slices(columns: list[pa.Array], of_row: Callable, kind: pa.DataType) -> pa.Array:
    """`of_row` of each row; only SLICE rows at a time are Python objects, a worker's batch may have many MB."""
    done = []
    for lo in range(0, len(columns[0]), SLICE):
        part = [c[lo : lo + SLICE].to_pylist() for c in columns]
        done.append(pa.array([of_row(*row) for row in zip(*part, strict=True)], kind))
    return pa.concat_arrays(done) if done else pa.array([], kind)


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def _segments(texts: pa.Array) -> pa.Array:
    return _by_slices([texts], segments, pa.list_(pa.int32()))


@F.arrow_udf(T.BinaryType())
def _shingles(texts: pa.Array) -> pa.Array:
    return _by_slices([texts], shingles, pa.binary())


@F.arrow_udf(T.IntegerType())
def _size(texts: pa.Array) -> pa.Array:
    return _by_slices([texts], lambda text: len(shingles(text)) // 4, pa.int32())


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def _numbers(sets: pa.Array) -> pa.Array:
    return _by_slices([sets], lambda x: np.frombuffer(x, dtype="<i4"), pa.list_(pa.int32()))


@F.arrow_udf(T.DoubleType())
def _jaccard(a: pa.Array, b: pa.Array) -> pa.Array:
    return _by_slices([a, b], jaccard, pa.float64())


def _halves(fp: Column) -> Column:
    """Of each segment, two rows: one half by which it is dealt, and the other."""
    low = F.lit((1 << HALF) - 1)

    def both(v: Column, s: Column) -> Column:
        high = F.shiftright(v, HALF)
        return F.array(
            F.struct((s * 2 * (1 << HALF) + high).alias("key"), v.bitwiseAND(low).alias("rest")),
            F.struct(((s * 2 + 1) * (1 << HALF) + v.bitwiseAND(low)).alias("key"), high.alias("rest")),
        )

    return F.flatten(F.transform(fp, both))


def _shared(table: pa.Table) -> pa.Table:
    """Variants that several nodes have, parted where their sizes have a gap: each part with its nodes and their number."""
    key, rest, node, size = (table.column(c).to_numpy().astype(np.int64) for c in ("key", "rest", "node", "size"))
    found = []
    for b in range(HALF):
        variant = (key * HALF + b) << HALF | rest & ~(1 << b)
        order = np.argsort(variant)
        ordered = variant[order]
        same = ordered[1:] == ordered[:-1]
        order = order[np.r_[False, same] | np.r_[same, False]]
        order = order[np.lexsort((size[order], variant[order]))]
        values, sizes = variant[order], size[order]
        apart = (values[1:] != values[:-1]) | (sizes[:-1] < SIMILARITY * sizes[1:] - EPSILON)
        starts = np.flatnonzero(np.r_[np.ones(min(1, len(order)), bool), apart])
        n = np.diff(np.r_[starts, len(order)])
        several = np.repeat(n > 1, n)
        # A part is named by its variant and its least size.
        names = np.repeat(values[starts] << 24 | np.minimum(sizes[starts], (1 << 24) - 1), n)
        found.append([names[several], node[order][several], np.repeat(n, n)[several]])
    columns = [pa.array(np.concatenate(c), pa.int64()) for c in zip(*found, strict=True)]
    return pa.Table.from_arrays(columns, names=["variant", "node", "n"])


def _partners(more: DataFrame) -> DataFrame:
    """(u, v): for each node the one that shares most, of those that share a variant with it, if not itself."""
    weight = more.groupBy("node").agg(F.sum("n").alias("weight"))
    tops = more.join(weight, "node").groupBy("variant").agg(F.max(F.struct("weight", "node")).alias("top"))
    best = more.join(tops, "variant").groupBy("node").agg(F.max("top").alias("top"))
    return best.select(F.col("node").alias("u"), F.col("top.node").alias("v")).filter("u <> v")


def _open_pairs(members: Column) -> Column:
    """Pairs of different roots, unless both are in crowds."""
    return F.flatten(
        F.transform(
            members,
            lambda a: F.transform(
                F.filter(
                    members, lambda b: (b.node < a.node) & (b.root != a.root) & ~(a.crowded & b.crowded)
                ),
                lambda b: F.struct(a.node.alias("u"), b.node.alias("v")),
            ),
        )
    )


def _size_class(size: Column) -> Column:
    return F.floor(F.log(F.greatest(size, F.lit(1.0))) * SIZE_CLASSES).cast("int")


def _prefix_pairs(members: DataFrame) -> DataFrame:
    """(u, v): pairs of different roots among `members` (node, root, set) that may be similar, all similar ones among them.

    Similar sets a and b have SIMILARITY / (1 + SIMILARITY) * (|a| + |b|) shingles in common. Those
    that occur in one root only are none of them. Of the others, rare ones first, each set has at least as
    many left from the first common one on. So pairs are matched by a shingle, and each side offers it only
    for the sizes that what it has left is enough for.
    """
    of_root = members.groupBy("root").agg(F.count(F.lit(1)).alias("many"))
    every = members.join(of_root, "root").select(
        "node", "root", "many", F.expr("octet_length(set) div 4").alias("size"), F.explode(_numbers("set")).alias("shingle")
    )
    known = every.groupBy("shingle").agg(F.count(F.lit(1)).alias("times"), F.min("root").alias("a"), F.max("root").alias("b"))
    useful = every.join(known.filter("a <> b").select("shingle", "times"), "shingle")
    common_first = Window.partitionBy("node").orderBy(F.desc("times"), F.desc("shingle"))
    enough = F.row_number().over(common_first) * ((1 + SIMILARITY) / SIMILARITY) - F.col("size")
    offers = useful.withColumn("most", F.least(enough, F.col("size") / SIMILARITY) + EPSILON)
    offers = offers.withColumn("fewest", F.col("size") * SIMILARITY - EPSILON).filter("most >= fewest")
    offers = offers.withColumn("own", _size_class(F.col("size").cast("double"))).withColumn(
        "other", F.explode(F.sequence(_size_class(F.col("fewest")), _size_class(F.col("most"))))
    )
    offers = offers.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))
    key = ["shingle", "low", "high"]
    offers = stored(offers.select(*key, "own", "other", "node", "root", "many", "size", "most"), "offers")
    # The largest root of a key is not matched with itself.
    tops = offers.groupBy(*key).agg(
        F.max(F.struct("many", "root")).alias("top"), F.min("root").alias("a"), F.max("root").alias("b")
    )
    tops = tops.filter("a <> b").select(*key, F.col("top.root").alias("top"))
    x = offers.join(tops, key).filter("root <> top").alias("x")
    y = offers.join(tops, key).alias("y")
    fits = (
        "x.shingle = y.shingle and x.own = y.other and x.other = y.own"
        " and x.root <> y.root and x.size <= y.most and y.size <= x.most"
    )
    pairs = x.join(y, F.expr(fits))
    return pairs.select(F.greatest("x.node", "y.node").alias("u"), F.least("x.node", "y.node").alias("v")).distinct()


def _close(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Distinct pairs whose fingerprints differ in FAR bits at most."""
    of = nodes.select("node", "fp")
    far = F.aggregate(
        F.zip_with("fp_u", "fp_v", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda t, x: t + x
    )
    return (
        pairs.distinct()
        .join(of.select(F.col("node").alias("u"), F.col("fp").alias("fp_u")), "u")
        .join(of.select(F.col("node").alias("v"), F.col("fp").alias("fp_v")), "v")
        .filter(far <= FAR)
        .select("u", "v")
    )


def _sets(wanted: DataFrame, nodes: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, set) of the nodes `wanted`. Only their texts are read for it."""
    firsts = nodes.join(wanted, "node").select(
        "node", F.col("first.doc_id").alias("_doc"), F.col("first.text_hash").alias("_hash")
    )
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.xxhash64(text_col).alias("_known"))
    own = texts.join(firsts, F.col("_id").eqNullSafe(F.col("_doc")) & (F.col("_known") == F.col("_hash")))
    sets = own.select("node", _shingles("_text").alias("set"))
    return stored(sets.groupBy("node").agg(F.first("set").alias("set")), "shingles")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose shingles are similar enough."""
    return (
        pairs.join(sets.select(F.col("node").alias("u"), F.col("set").alias("set_u")), "u")
        .join(sets.select(F.col("node").alias("v"), F.col("set").alias("set_v")), "v")
        .filter(_jaccard("set_u", "set_v") >= SIMILARITY)
        .select("u", "v")
    )


def _roots(nodes: DataFrame, more: DataFrame, docs: DataFrame, id_col: str, text_col: str, crowd: int) -> DataFrame:
    """(node, root) of nodes that are similar to another; `more` has those that share a variant."""
    first = stored(_close(_partners(more), nodes), "pairs")
    links = stored(_similar(first, _sets(_ends(first), nodes, docs, id_col, text_col)), "links")
    roots = least_reachable(links)
    # Of variants whose members are not all connected: pairs that are not.
    named = more.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_ = named.groupBy("variant").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a <> b")
    named = stored(named.join(open_.select("variant"), "variant"), "open-variants")
    crowded = stored(named.filter(F.col("n") > crowd).select("node", "root").distinct(), "crowds")
    few = named.filter(F.col("n") <= crowd).join(crowded.select("node", F.lit(True).alias("crowded")), "node", "left")
    few = few.withColumn("crowded", F.coalesce("crowded", F.lit(False)))
    few = few.groupBy("variant").agg(F.collect_list(F.struct("node", "root", "crowded")).alias("members"))
    few = stored(_close(few.select(F.explode(_open_pairs(F.col("members"))).alias("p")).select("p.*"), nodes), "pairs")
    sets = _sets(_ends(few).union(crowded.select("node")).distinct(), nodes, docs, id_col, text_col)
    many = _prefix_pairs(crowded.join(sets, "node"))
    more_links = stored(_similar(stored(few.unionByName(many), "pairs"), sets), "links")
    if more_links.isEmpty():
        return roots
    return least_reachable(roots.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(more_links))


def _classes(docs: DataFrame, prints: DataFrame, id_col: str, text_col: str, crowd: int) -> DataFrame:
    """(fp, first): the first row (by id, nulls last, then text hash) of its class."""
    row = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_hash", "size")
    nodes = prints.groupBy("fp").agg(F.min(row).alias("first"))
    nodes = stored(nodes.withColumn("node", F.xxhash64("fp")), "fingerprints")
    groups = max(1, nodes.count() * 2 * SEGMENTS // GROUP)
    index = nodes.select("node", F.col("first.size").alias("size"), F.explode(_halves(F.col("fp"))).alias("h"))
    index = index.select("node", "size", "h.*").withColumn("part", F.pmod(F.xxhash64("key"), F.lit(groups)).cast("int"))
    more = index.groupBy("part").applyInArrow(_shared, "variant long, node long, n long")
    roots = _roots(nodes, stored(more, "shared-variants"), docs, id_col, text_col, crowd)
    of = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    firsts = of.groupBy("root").agg(F.min("first").alias("first"))
    return of.select("fp", "root").join(firsts, "root").select("fp", "first")


def _prints(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col)
    prints = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), _segments(text).alias("fp"), _size(text).alias("size")
    )
    return stored(prints, "prints")


def near_copy_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", crowd: int = CROWD
) -> DataFrame:
    """doc_id, class_id of every input row; class_id is the least doc_id of its class.

    Texts without words are one class. Rows with one id are documents of their own;
    null ids name no class unless all of its ids are null. Other columns are not
    looked at.
    """
    prints = _prints(docs, id_col, text_col)
    of = _classes(docs, prints, id_col, text_col, crowd).select("fp", F.col("first.doc_id").alias("class_id"))
    return prints.join(of, "fp").select("doc_id", "class_id")


def first_of_each_class(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", crowd: int = CROWD
) -> DataFrame:
    """The rows of `docs`, one of each class: that with the least id, nulls last.

    All columns stay, whatever their names; of repeated rows one is left.
    """
    prints = _prints(docs, id_col, text_col)
    firsts = _classes(docs, prints, id_col, text_col, crowd).select("first.*").distinct()
    this, that, known, number = unused(docs, "id", "hash", "text_hash", "number")
    firsts = firsts.select(F.col("doc_id").alias(this), F.col("text_hash").alias(that))
    rows = docs.withColumn(known, F.xxhash64(F.col(text_col)))
    kept = rows.join(firsts, F.col(id_col).eqNullSafe(F.col(this)) & (F.col(known) == F.col(that)), "left_semi")
    order = Window.partitionBy(id_col, known).orderBy(F.lit(1))
    return kept.withColumn(number, F.row_number().over(order)).filter(F.col(number) == 1).select(*docs.columns)
