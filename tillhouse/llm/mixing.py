"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

The documents of a source, in an order given by hashes, are one stream of words cut
into blocks of whole documents. A source's target says how many whole passes and how
many more blocks, in an order of their own, are drawn; the last block is cut so that
the words taken equal the target. How many blocks of each source an output shard gets
is decided by a tree: a node's quotas are split between its halves by a multivariate
hypergeometric draw, down to single shards, so shards are filled exactly and blocks
are disjoint. Within a shard, documents follow a hash.

No task sees a whole source: prefix sums go over hash buckets. Tables over sources,
blocks and shards are bounded by the number of sources and the parameters.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillhouse.llm.shared import WORD, let, stored, text_or_empty, unused


@dataclass(frozen=True)
class Mix:
    """Sources in order of code points, null last, weigh `weights`, repeating; together
    they share `share` times all sizes, none more than `most` times its own size."""

    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    share: float = 1.5
    most: int = 2
    shards: int = 64  # a power of two
    blocks: int = 4096  # about; all sources together
    buckets: int = 4096  # of a source, for prefix sums
    seed: int = 7

    def __post_init__(self):
        if self.shards < 1 or self.shards & (self.shards - 1):
            raise ValueError("shards must be a power of two")
        if self.share > self.most:
            raise ValueError("the sources cannot give that much")

    def hash(self, *parts) -> Column:
        return F.xxhash64(F.lit(self.seed), *parts)


def _targets(per_bucket: DataFrame, mix: Mix) -> DataFrame:
    """One row per source: source_no, source_size, target, passes, rest, block_size."""
    s = per_bucket.groupBy("source_key").agg(F.first("source").alias("source"), F.sum("words").alias("source_size"))
    everything = Window.partitionBy(F.lit(1))
    weights = F.array(*[F.lit(float(w)) for w in mix.weights])
    number = F.row_number().over(everything.orderBy(F.col("source").isNull(), "source")) - 1
    s = s.withColumn("source_no", number)
    s = s.withColumn("weight", F.get(weights, F.col("source_no") % len(mix.weights)))
    s = s.withColumn("limit", F.col("source_size") * mix.most)
    # Water level: limits are reached in order of limit / weight.
    by_level = everything.orderBy(F.col("limit") / F.col("weight"), "source_no")
    before = F.coalesce(F.sum("limit").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    from_here = F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing))
    pot = F.sum("source_size").over(everything) * mix.share
    level = (pot - before) / from_here
    s = s.withColumn("level", level).withColumn("position", F.row_number().over(by_level))
    final = F.min_by(
        F.when(F.col("level") * F.col("weight") < F.col("limit"), F.col("level")),
        F.when(F.col("level") * F.col("weight") < F.col("limit"), F.col("position")),
    ).over(everything)
    target = F.least(F.col("limit").cast("double"), F.coalesce(final * F.col("weight"), F.col("limit").cast("double")))
    s = s.withColumn("target", target)
    wanted = F.least(F.round("target").cast("long"), F.col("limit"))
    passes = F.when(F.col("source_size") > 0, F.floor(wanted / F.col("source_size"))).otherwise(F.lit(0))
    s = s.withColumn("wanted", wanted).withColumn("passes", passes.cast("int"))
    block_size = F.greatest(F.ceil(F.sum("wanted").over(everything) / mix.blocks), F.lit(1))
    return s.select(
        "source_key", "source_no", "source_size", "target", "passes",
        (F.col("wanted") - F.col("passes") * F.col("source_size")).alias("rest"), block_size.alias("block_size"),
    )


# ---- the splitting tree -----------------------------------------------------------


def _hypergeometric(total: Column, good: Column, draws: Column, u: Column) -> Column:
    """How many of `draws` out of `total` are among the `good`, for a uniform `u`.

    The distribution function is inverted over outcomes in the order mode, those
    above, those below; weights follow from the mode's by their ratios.
    """
    low = F.greatest(F.lit(0), draws - (total - good))
    high = F.least(good, draws)

    def run(start: Column, end: Column, step: int, ratio) -> Column:
        """Outcomes after the mode, each with the sum of weights up to it."""
        ks = F.when((end - start) * step > 0, F.sequence(start + F.lit(step), end, F.lit(step).cast("long")))
        state = F.struct(F.lit(1.0).alias("w"), F.array().cast("array<struct<k:bigint,w:double>>").alias("all"))

        def add(acc: Column, k: Column) -> Column:
            return let(
                acc["w"] * ratio(k),
                lambda w: F.struct(
                    w.alias("w"), F.concat(acc["all"], F.array(F.struct(k.alias("k"), w.alias("w")))).alias("all")
                ),
            )

        return F.aggregate(F.coalesce(ks, F.array().cast("array<bigint>")), state, add)["all"]

    def up(k: Column) -> Column:  # weight of k over that of k - 1
        j = (k - 1).cast("double")
        return (good - j) * (draws - j) / ((j + 1) * (total - good - draws + j + 1))

    def down(k: Column) -> Column:  # weight of k over that of k + 1
        j = (k + 1).cast("double")
        return j * (total - good - draws + j) / ((good - j + 1) * (draws - j + 1))

    def pick(mode: Column) -> Column:
        outcomes = F.concat(
            F.array(F.struct(mode.alias("k"), F.lit(1.0).alias("w"))), run(mode, high, 1, up), run(mode, low, -1, down)
        )
        return let(outcomes, lambda o: _first_reaching(o, u))

    mode = F.floor((draws + 1) * (good + 1) / (total + 2)).cast("long")
    return let(F.least(F.greatest(mode, low), high), pick)


def _first_reaching(outcomes: Column, u: Column) -> Column:
    whole = F.aggregate(outcomes, F.lit(0.0), lambda t, o: t + o["w"])
    state = F.struct(F.lit(0.0).alias("sum"), F.lit(None).cast("long").alias("k"))
    found = F.aggregate(
        outcomes,
        state,
        lambda acc, o: F.struct(
            (acc["sum"] + o["w"]).alias("sum"),
            F.when(acc["k"].isNull() & (acc["sum"] + o["w"] >= u * whole), o["k"]).otherwise(acc["k"]).alias("k"),
        ),
    )["k"]
    return F.coalesce(found, F.element_at(outcomes, -1)["k"])


def _left_quotas(quotas: Column, draws: Column, uniform) -> Column:
    """Multivariate hypergeometric draw: source by source, given those before."""
    start = F.struct(
        F.aggregate(quotas, F.lit(0).cast("long"), lambda t, q: t + q).alias("total"),
        draws.alias("draws"),
        F.array().cast("array<bigint>").alias("left"),
    )

    def step(acc: Column, quota: Column) -> Column:
        drawn = _hypergeometric(acc["total"], quota, acc["draws"], uniform(F.size(acc["left"])))
        return let(
            drawn,
            lambda x: F.struct(
                (acc["total"] - quota).alias("total"),
                (acc["draws"] - x).alias("draws"),
                F.concat(acc["left"], F.array(x)).alias("left"),
            ),
        )

    return F.aggregate(quotas, start, step)["left"]


def split_quotas(quotas: DataFrame, mix: Mix) -> DataFrame:
    """From one row (quotas: array of blocks by source) to one row (shard, quotas) a shard."""
    whole = F.aggregate("quotas", F.lit(0).cast("long"), lambda t, q: t + q)
    nodes = quotas.select(
        F.lit(0).cast("long").alias("low"), F.lit(mix.shards).cast("long").alias("high"), "quotas", whole.alias("all")
    )
    width = mix.shards
    while width > 1:
        width //= 2
        middle = F.col("low") + width
        bound = lambda at: F.floor(at * F.col("all") / mix.shards)
        draws = (bound(middle) - bound(F.col("low"))).cast("long")
        uniform = lambda i: (F.pmod(mix.hash(F.col("low"), F.col("high"), i), F.lit(1 << 53)) + 0.5) / float(1 << 53)
        nodes = nodes.withColumn("left", _left_quotas(F.col("quotas"), draws, uniform))
        right = F.zip_with("quotas", "left", lambda q, x: q - x)
        halves = F.array(
            F.struct(F.col("low"), middle.alias("high"), F.col("left").alias("quotas")),
            F.struct(middle.alias("low"), F.col("high"), right.alias("quotas")),
        )
        nodes = nodes.select("all", F.explode(halves).alias("x")).select("x.*", "all")
    return nodes.select(F.col("low").alias("shard"), "quotas")


# ---- the mix ------------------------------------------------------------------------


def _drawn_blocks(positions: DataFrame, mix: Mix) -> DataFrame:
    """(source_key, block, block_start, rest_words, shards): where each drawn block goes.

    `shards` has one entry per whole pass and one for the cut pass if it is drawn there.
    """
    blocks = positions.groupBy("source_key", "block").agg(
        F.min("start").alias("block_start"), F.sum("size").alias("words"),
        *[F.first(c).alias(c) for c in ("source_no", "passes", "rest")],
    )
    order = Window.partitionBy("source_key").orderBy(mix.hash(F.lit("rest"), "source_no", "block"), "block")
    before = F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.greatest(F.least(F.col("words"), F.col("rest") - before), F.lit(0))
    blocks = blocks.withColumn("rest_words", rest)
    passes = F.col("passes") + F.when(F.col("rest_words") > 0, 1).otherwise(0)
    units = blocks.withColumn(
        "pass", F.explode(F.when(passes > 0, F.sequence(F.lit(0), passes - 1)))
    )
    deal = Window.partitionBy("source_no").orderBy(mix.hash(F.lit("unit"), "source_no", "block", "pass"), "block", "pass")
    units = units.withColumn("rank", F.row_number().over(deal).cast("long"))
    counts = units.groupBy("source_no").agg(F.count(F.lit(1)).alias("units"))
    by_source = F.array_sort(F.collect_list(F.struct("source_no", "units")))
    root = counts.agg(by_source.alias("s")).select(
        F.col("s.source_no").alias("source_nos"), F.col("s.units").alias("quotas")
    )
    numbers = root.select("source_nos")
    leaves = split_quotas(root, mix).select("shard", F.posexplode("quotas").alias("at", "quota"))
    named = numbers.select(F.posexplode("source_nos").alias("at", "source_no"))
    leaves = leaves.join(named, "at")
    earlier = F.coalesce(
        F.sum("quota").over(
            Window.partitionBy("source_no").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
        ),
        F.lit(0),
    )
    slots = leaves.withColumn("earlier", earlier).filter("quota > 0").select(
        "source_no", "shard", F.explode(F.sequence(F.col("earlier") + 1, F.col("earlier") + F.col("quota"))).alias("rank")
    )
    return (
        units.join(slots, ["source_no", "rank"])
        .groupBy("source_key", "block", "block_start", "rest_words")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("pass", "shard"))), lambda x: x["shard"]).alias("shards"))
    )


def mix_rows(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", mix: Mix = Mix()
) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, taken, text_hash, parts.

    `parts` lists what the mix takes: (shard, n_words: so many from the beginning).
    Null and empty texts have size 0 and are not taken; a null source is a source of
    its own, the last; repeated rows and null ids are documents of their own; if all
    sizes are 0, targets are. Other columns are not looked at.
    """
    text = F.col(text_col)
    key = F.when(F.col(source_col).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(source_col)))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        key.alias("source_key"),
        F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(text).alias("text_hash"),
    ).withColumn("order", mix.hash(F.lit("document"), "doc_id", "text_hash"))
    rows = stored(rows.withColumn("bucket", F.pmod("order", F.lit(mix.buckets))), "sizes")
    per_bucket = stored(
        rows.groupBy("source_key", "bucket").agg(F.first("source").alias("source"), F.sum("size").alias("words")),
        "buckets",
    )
    before = F.coalesce(
        F.sum("words").over(
            Window.partitionBy("source_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        ),
        F.lit(0),
    )
    offsets = per_bucket.select("source_key", "bucket", before.alias("offset")).join(_targets(per_bucket, mix), "source_key")
    within = Window.partitionBy("source_key", "bucket").orderBy("order", "doc_id", "text_hash", "size")
    start = F.col("offset") + F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    positions = rows.drop("source").join(offsets, ["source_key", "bucket"]).withColumn("start", start)
    # Documents without words go to blocks of their own, spread out, which are never drawn.
    block = F.when(F.col("size") > 0, F.floor(F.col("start") / F.col("block_size"))).otherwise(-1 - F.col("bucket"))
    positions = stored(positions.withColumn("block", block.cast("long")), "positions")
    drawn = _drawn_blocks(positions.filter("size > 0"), mix)
    p = positions.join(drawn, ["source_key", "block"], "left")
    cut = F.least(F.col("size"), F.greatest(F.col("rest_words") - (F.col("start") - F.col("block_start")), F.lit(0)))
    parts = F.filter(
        F.transform(
            F.coalesce("shards", F.array().cast("array<bigint>")),
            lambda shard, i: F.struct(
                shard.alias("shard"), F.when(i < F.col("passes"), F.col("size")).otherwise(cut).alias("n_words")
            ),
        ),
        lambda part: part["n_words"] > 0,
    )
    p = p.withColumn("parts", parts)
    taken = F.aggregate("parts", F.lit(0).cast("long"), lambda t, part: t + part["n_words"])
    return p.select("doc_id", "size", "source_size", "target", taken.alias("taken"), "text_hash", "parts", "order")


def mixed_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    chars_col: str | None = "n_chars",
    mix: Mix = Mix(),
) -> DataFrame:
    """The mix itself: the columns of `docs`, a row for each time a document is taken,
    shard by shard and shuffled within. The document at a cut keeps its first words;
    `chars_col`, if there is one, is its new length."""
    rows = mix_rows(docs, id_col, text_col, source_col, mix).filter("taken > 0")
    this, that, known, number, part, order = unused(docs, "id", "hash", "text_hash", "number", "part", "order")
    takes = rows.groupBy(F.col("doc_id").alias(this), F.col("text_hash").alias(that), F.col("size"), F.col("order").alias(order)).agg(
        F.flatten(F.collect_list("parts")).alias(part)
    )
    takes = takes.select(this, that, order, F.struct("size", F.col(part).alias("parts")).alias(part))
    # Equal rows have equal keys: one of them carries what all of them give.
    alone = Window.partitionBy(id_col, known).orderBy(F.lit(1))
    one = docs.withColumn(known, F.xxhash64(F.col(text_col))).withColumn(number, F.row_number().over(alone))
    joined = one.filter(F.col(number) == 1).join(
        takes, F.col(id_col).eqNullSafe(F.col(this)) & (F.col(known) == F.col(that))
    )
    size = F.col(part)["size"]
    joined = joined.withColumn(
        part,
        F.explode(F.transform(F.col(part)["parts"], lambda p: F.struct(p.alias("take"), (p["n_words"] < size).alias("cut")))),
    )
    text = F.col(text_col)
    first_words = F.array_join(
        F.slice(F.regexp_extract_all(text, F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0)), 1, F.col(part)["take"]["n_words"].cast("int")),
        "",
    )
    joined = joined.withColumn(text_col, F.when(F.col(part)["cut"], first_words).otherwise(text))
    if chars_col in docs.columns:
        kind = docs.schema[chars_col].dataType
        new = F.when(F.col(part)["cut"], F.length(text_col).cast(kind)).otherwise(F.col(chars_col))
        joined = joined.withColumn(chars_col, new)
    shard = F.col(part)["take"]["shard"]
    return joined.repartition(mix.shards, shard).sortWithinPartitions(shard, order, known).select(*docs.columns)
