"""Secret scans: fixed patterns, and strings that look drawn at random.

Two character Markov models, one of secrets and one of ordinary identifiers, are
counted from labelled samples; a token is a secret if the log-likelihood ratio of
its characters reaches a threshold. All of it is Spark expressions; the model is a
table over pairs of ALPHABET characters, whatever the size of the input.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.shared import let, sample_texts, text_or_empty

# Fixed patterns and least lengths.
ASSIGN = (
    r"""(?:(?i)(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_VALUE = 8
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "markov")

#: Tokens that the models judge: whole runs of these, of letters and digits both.
TOKEN = r"(?<![A-Za-z0-9+/_-])(?=[+/_-]*[A-Za-z0-9])[A-Za-z0-9+/_-]{16,}"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-"
_STATES = len(ALPHABET) + 1  # 0: any other character, and the place before the first
#: Bound on the documents that labelled samples are taken from, about.
SAMPLE_DOCS = 20_000
THRESHOLD = 20.0
MARK = "[secret]"


#: Numbers that are added up in one go; bounds what appending to an array costs.
_BLOCK = 256


def _running_sums(numbers: Column) -> Column:
    """Sums of the first 1, 2, … of an array of ints, in blocks: work in proportion to
    the length, but for a small part."""
    none = F.array().cast("array<int>")

    def sums(block: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), none.alias("all"))
        return F.aggregate(
            block,
            start,
            lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["all"], F.array(acc["at"] + n)).alias("all")),
        )

    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.greatest(F.size(numbers), F.lit(1)) - 1) / _BLOCK).cast("int")),
        lambda k: sums(F.slice(numbers, k * _BLOCK + 1, _BLOCK)),
    )

    def joined(blocks: Column) -> Column:
        before = F.concat(F.array(F.lit(0)), sums(F.transform(blocks, lambda b: b["at"]))["all"])
        offset = F.zip_with(F.slice(before, 1, F.size(blocks)), blocks, lambda o, b: F.struct(o.alias("o"), b.alias("b")))
        return F.flatten(F.transform(offset, lambda x: F.transform(x["b"]["all"], lambda n: n + x["o"])))

    return F.when(F.size(numbers) == 0, none).otherwise(let(blocks, joined))


def _placed(text: Column, pattern: str, order: int, ok: Column | None = None) -> Column:
    """Spans (start, order, end) of the matches, in code points; `ok`: which matches stay."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.array().cast("array<struct<start:int,order:int,end:int>>")

    def place(matches: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), 1, F.size(matches))
        lengths = F.transform(matches, lambda m: F.length(m))
        steps = F.zip_with(gaps, lengths, lambda gap, n: F.length(gap) + n)
        spans = let(
            _running_sums(steps),
            lambda ends: F.zip_with(
                ends, lengths, lambda end, n: F.struct((end - n).alias("start"), F.lit(order).alias("order"), end.alias("end"))
            ),
        )
        if ok is not None:
            spans = F.filter(F.zip_with(spans, ok, lambda s, o: F.when(o, s)), lambda s: s.isNotNull())
        return F.when(F.size(matches) == 0, none).otherwise(spans)

    return let(found, place)


def base_spans(text: Column) -> Column:
    """Spans of the fixed patterns, by start and kind."""
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    long_enough = F.transform(values, lambda v: F.length(v) >= ASSIGN_VALUE)
    return F.sort_array(
        F.concat(_placed(text, ASSIGN, 0, long_enough), _placed(text, ACCESS, 1), _placed(text, HEX, 2))
    )


# ---- the models -----------------------------------------------------------------


@dataclass(frozen=True)
class MarkovModels:
    """log P(next | previous, secret) - log P(next | previous, ordinary), row by row."""

    ratios: tuple[float, ...]

    def score(self, token: Column) -> Column:
        table = F.split(F.lit(",".join(f"{r:.6f}" for r in self.ratios)), ",").cast("array<double>")
        return F.aggregate(
            _pairs_of(token), F.lit(0.0), lambda total, t: total + F.get(table, t)
        )


def _pairs_of(token: Column) -> Column:
    """Index of each pair of neighbouring characters in the table of ratios."""
    states = F.transform(F.filter(F.split(token, ""), lambda c: c != ""), lambda c: F.call_function("instr", F.lit(ALPHABET), c))
    return let(
        states,
        lambda s: F.zip_with(
            F.slice(F.concat(F.array(F.lit(0)), s), 1, F.size(s)), s, lambda a, b: a * _STATES + b
        ),
    )


def train(samples: DataFrame, token_col: str = "token", secret_col: str = "secret") -> MarkovModels:
    """Models from rows (token, secret: boolean); rows with a null in either do not count.

    Every pair starts with a count of one, so without samples all strings are alike.
    """
    pairs = samples.filter(F.col(secret_col).isNotNull() & F.col(token_col).isNotNull()).select(
        F.col(secret_col).alias("secret"), F.explode(_pairs_of(F.col(token_col))).alias("pair")
    )
    # At most twice the square of the alphabet's size.
    counted = {(r["secret"], r["pair"]): r["count"] for r in pairs.groupBy("secret", "pair").count().collect()}
    ratios = []
    for a in range(_STATES):
        totals = {s: sum(counted.get((s, a * _STATES + b), 0) + 1 for b in range(_STATES)) for s in (True, False)}
        for b in range(_STATES):
            logs = [math.log((counted.get((s, a * _STATES + b), 0) + 1) / totals[s]) for s in (True, False)]
            ratios.append(logs[0] - logs[1])
    return MarkovModels(tuple(ratios))


def labelled_samples(docs: DataFrame, text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(token, secret) from `sample_docs` distinct texts, chosen by hash: what the fixed
    patterns find is a secret, any other word of eight or more characters is ordinary."""
    chosen = sample_texts(docs, text_col, sample_docs)
    blank = reduce(lambda t, p: F.regexp_replace(t, p, " "), (ASSIGN, ACCESS, HEX), F.col("text"))
    secret = F.concat(
        F.filter(F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v) >= ASSIGN_VALUE),
        F.regexp_extract_all("text", F.lit(ACCESS), F.lit(0)),
        F.regexp_extract_all("text", F.lit(HEX), F.lit(0)),
    )
    ordinary = F.filter(F.split(blank, r"[\x20\x09-\x0D]+"), lambda w: F.length(w) >= 8)
    both = F.concat(
        F.transform(secret, lambda v: F.struct(v.alias("token"), F.lit(True).alias("secret"))),
        F.transform(ordinary, lambda v: F.struct(v.alias("token"), F.lit(False).alias("secret"))),
    )
    return chosen.select(F.explode(both).alias("s")).select("s.*")


def model_spans(text: Column, base: Column, models: MarkovModels, threshold: float = THRESHOLD) -> Column:
    """Spans of tokens that score at least `threshold` and that no base span covers wholly."""
    tokens = F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))
    random = F.transform(
        tokens,
        lambda t: t.rlike("[0-9]") & t.rlike("[A-Za-z]") & (models.score(t) >= threshold),
    )
    return F.filter(
        _placed(text, TOKEN, 3, random),
        lambda s: ~F.exists(base, lambda b: (b["start"] <= s["start"]) & (s["end"] <= b["end"])),
    )


def scan(text: Column, models: MarkovModels) -> Column:
    """Struct (base, spans) of a text; a null text has none."""
    text = text_or_empty(text)
    return let(
        base_spans(text),
        lambda base: F.struct(
            base.alias("base"), F.sort_array(F.concat(base, model_spans(text, base, models))).alias("spans")
        ),
    )


def _digest(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["order"]), s["start"], s["end"])), ","
    )


def secret_report(docs: DataFrame, models: MarkovModels, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_markov of every input row.

    Null and empty texts have no spans; repeated rows and null ids are rows like
    others; other columns are not looked at.
    """
    found = docs.select(F.col(id_col).alias("doc_id"), scan(F.col(text_col), models).alias("found"))

    def number(order: int) -> Column:
        return F.size(F.filter(F.col("found.spans"), lambda s: s["order"] == order)).cast("long")

    return found.select(
        "doc_id",
        *[number(k).alias(f"n_{KINDS[k]}") for k in range(3)],
        F.sha2(_digest(F.col("found.base")), 256).alias("base_sha256"),
        _digest(F.col("found.spans")).alias("spans"),
        number(3).alias("n_markov"),
    )


def redacted(text: Column, models: MarkovModels, mark: str = MARK) -> Column:
    """The text with every run of overlapping spans replaced by `mark`; null stays null."""

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        before = F.substr(text, acc["at"] + F.lit(1), F.greatest(s["start"] - acc["at"], F.lit(0)))
        return F.struct(
            F.when(fresh, F.concat(acc["done"], before, F.lit(mark))).otherwise(acc["done"]).alias("done"),
            F.greatest(acc["at"], s["end"]).alias("at"),
        )

    def rebuilt(spans: Column) -> Column:
        start = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))
        whole = F.aggregate(spans, start, step, lambda acc: F.concat(acc["done"], F.substr(text, acc["at"] + F.lit(1))))
        return F.when(F.size(spans) == 0, text).otherwise(whole)

    return F.when(text.isNotNull(), let(scan(text, models)["spans"], rebuilt))
