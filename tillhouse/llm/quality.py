"""Quality rules: a table of thresholds compiled into one projection.

Everything is a Spark expression on one text; nothing is shuffled, and a row
costs time in n log n of its own words.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.shared import SPACE, let, text_or_empty, words

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# Frequent short words of English, German, French and Spanish, in lower case.
STOP_WORDS = (
    "the of and to in a is that it for on was with as be by at this are not "
    "der die das und ist zu von den mit ein eine nicht für auf dem im sich des "
    "le la les de des et un une du en est que pour dans pas sur au "
    "el los las y es por con del se al lo para no una su"
).split()


@dataclass(frozen=True)
class Rule:
    """Keep texts whose measure (a division by zero counts as 0) is in [low, high]."""

    name: str
    over: str
    under: str | None = None
    low: float | None = None
    high: float | None = None

    def passes(self, m: Column) -> Column:
        value = m[self.over].cast("double")
        if self.under is not None:
            part = m[self.under]
            value = F.when(part == 0, F.lit(0.0)).otherwise(value / part)
        ok = F.lit(True)
        if self.low is not None:
            ok = ok & (value >= self.low)
        if self.high is not None:
            ok = ok & (value <= self.high)
        return ok


RULES = (
    Rule("mean word length", "word_chars", "n_words", low=3.0, high=10.0),
    Rule("symbols per word", "n_symbols", "n_words", high=0.1),
    Rule("stop words per word", "n_stop_words", "n_words", low=0.02),
    Rule("repeated lines", "n_dup_lines", "n_lines", high=0.5),
    Rule("lines ending in an ellipsis", "n_ellipsis_lines", "n_lines", high=0.3),
    Rule("lines starting with a bullet", "n_bullet_lines", "n_lines", high=0.9),
)


def repeat_words(w: Column, size: int = 3) -> Column:
    """Words of an array that are in a window of `size` words found twice or more.

    Windows are sorted as longs: hash bits above, start below. Neighbours with the
    same hash bits and the same words are repeats. Two windows that share 64 bits
    less those of a start, about n * n / 2^64 * n of n words, could hide one.
    """
    n = F.size(w)
    starts = F.when(n >= size, F.sequence(F.lit(0), n - size)).otherwise(F.array().cast("array<int>"))
    bits = F.length(F.bin(n))

    def word(i: Column, k: int) -> Column:
        return F.get(w, i + F.lit(k))

    def repeated(b: Column) -> Column:
        """Starts of repeated windows, sorted."""
        packed = F.transform(
            starts,
            lambda i: F.call_function(
                "shiftleft", F.xxhash64(*[word(i, k) for k in range(size)]), b
            ).bitwiseOR(i.cast("long")),
        )
        low = F.call_function("shiftleft", F.lit(1).cast("long"), b) - F.lit(1).cast("long")

        def twins(x: Column, y: Column) -> Column:
            same = F.call_function("shiftright", x, b) == F.call_function("shiftright", y, b)
            i, j = x.bitwiseAND(low).cast("int"), y.bitwiseAND(low).cast("int")
            equal = [word(i, k) == word(j, k) for k in range(size)]
            for e in equal:
                same = same & e
            return F.when(same, F.array(i, j))

        pairs = let(F.sort_array(packed), lambda s: F.zip_with(s, after_first(s), twins))
        return F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull()))))

    def covered(at: Column) -> Column:
        """Words in windows at these starts: each adds what the next leaves to it."""
        steps = F.zip_with(at, after_first(at), lambda x, y: F.least(F.coalesce(y - x, F.lit(size)), F.lit(size)))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)

    return let(bits, lambda b: let(repeated(b), covered))


def after_first(items: Column) -> Column:
    return F.slice(items, 2, F.greatest(F.size(items), F.lit(1)))


def measures(text: Column) -> Column:
    """Struct of the counts that rules refer to, all long. A null text counts as empty."""
    text = text_or_empty(text)
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))

    def counts(w: Column, ls: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
            repeat_words(w).alias("n_repeat_words"),
            F.size(F.filter(w, lambda x: x.isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
            F.size(ls).cast("long").alias("n_lines"),
            F.size(F.filter(ls, lambda x: x.rlike(rf"(\.\.\.|…){SPACE}*$"))).cast("long").alias("n_ellipsis_lines"),
            F.size(F.filter(ls, lambda x: x.rlike(rf"^{SPACE}*[-*•‣▪]"))).cast("long").alias("n_bullet_lines"),
        )

    return let(words(text), lambda w: let(lines, lambda ls: counts(w, ls)))


def verdict(m: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Struct (base_failed, failed: names of the rules not met, kept)."""
    base = (m["n_words"] < MIN_WORDS) | (F.lit(100) * m["n_repeat_words"] > F.lit(MAX_REPEAT_PERCENT) * m["n_words"])
    failed = F.filter(
        F.array(*[F.when(~r.passes(m), F.lit(r.name)) for r in rules]).cast("array<string>"),
        lambda name: name.isNotNull(),
    )
    return let(
        failed,
        lambda f: F.struct(base.alias("base_failed"), f.alias("failed"), (~base & (F.size(f) == 0)).alias("kept")),
    )


def quality_report(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """One row per input row: id, all counts, base_failed, kept, failed rules.

    Null and empty texts have no words and are not kept; repeated rows and null
    ids are rows like others; an empty table gives an empty result; other columns
    are not looked at.
    """
    m = docs.select(F.col(id_col).alias("doc_id"), measures(F.col(text_col)).alias("m"))
    return m.select("doc_id", "m.*", let(F.col("m"), lambda x: verdict(x, rules)).alias("v")).select("*", "v.*").drop("v")


def keep_good(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows whose text passes, with all their columns, whatever their names."""
    return docs.filter(let(measures(F.col(text_col)), lambda m: verdict(m, rules))["kept"])
