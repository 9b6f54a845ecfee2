"""Main text of web pages: the maximum-scoring contiguous run of tokens.

A page is a sequence of words and tags. Words score positive and tags negative, by the
block that words are in, the name of a tag, and whether an article is open around them:
the log odds of these, counted from pages that label their article, are kept within
positive bounds for words and negative ones for tags. One linear scan finds the run with
the greatest sum. Left out of it are blocks that are never the article by their element
name (menus, forms, scripts, ...), and containers whose class, role or id speaks of an
advert, a notice, reader comments and the like: each part of such a name has a weight,
log odds from the labelled pages or, for a short list of words, a fixed one.

A page is read in one pass, with work in proportion to its length however broken it is.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.llm.shared import sample_texts

#: Bound on the distinct pages that weights are counted from.
SAMPLE_PAGES = 4000
#: Bounds of the weight of a word and of a tag, and the weights where nothing is known.
WORD_BOUNDS, WORD_WEIGHT = (0.5, 2.0), 1.0
TAG_BOUNDS, TAG_WEIGHT = (-1.5, -0.1), -0.5
#: Log odds stay within these, so that no single feature decides alone.
LIMIT = 8.0
#: A name is not the article's if its parts weigh this on average, or less.
NEVER_WEIGHT = -2.0
SPOKEN_OF = -4.0  # weight of the parts below

# Element names of the HTML standard.
RAW = "script style textarea title noscript template iframe xmp svg math".split()
#: Of those, what a page that does not close them has no more text after.
ENDLESS = "script style textarea title".split()
#: Of those, what can close itself.
FOREIGN = "svg math".split()
VOID = "area base br col embed hr img input link meta param source track wbr".split()
BLOCKS = (
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav "
    "ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul"
).split()
LABELS = ("article", "main")
NEVER = "nav aside footer header form button select menu dialog head".split()
CONTAINERS = "div section ul ol dl table".split()
# Parts of names of containers that are not the article.
SPEAKS = (
    "ad advert advertisement advertising alert banner breadcrumb comment complementary consent contentinfo cookie dialog "
    "disclaimer disqus footer gdpr header legal login masthead menu modal nav navbar navigation newsletter notice overlay pager "
    "pagination popup promo promotion recommend recommendation recommended related reply replies search share sharing sidebar "
    "signin signup social sponsor sponsored subscribe toolbar widget"
).split()
# Parts that say nothing.
FILLER = (
    "area bar block body box col column container content global group holder inner item list outer page panel "
    "post reader region row section site slot unit user view wrap wrapper"
).split()
_speaks, _filler = set(SPEAKS), set(FILLER)
_part = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_name = re.compile(r"/?[A-Za-z][^\s/>]*")
_attribute = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_stop = re.compile(r">|=\s*([\"'])")
_raw_end = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
_open_value = re.compile(r"=\s*[^\s\"'=<>`]*/$")  # a slash that belongs to a value without quotes
_raw, _void, _blocks, _never, _containers = set(RAW), set(VOID), set(BLOCKS), set(NEVER), set(CONTAINERS)


def _parts(name: str) -> list[str]:
    """Parts of a class, role or id that may say something, in singular."""
    found = [m.lower() for m in _part.findall(name)]
    return [p for p in (x[:-1] if len(x) > 2 and x.endswith("s") and not x.endswith("ss") else x for x in found) if p not in _filler]


@dataclass
class Weights:
    """Log odds by feature; `part x` for parts of names."""

    known: dict[str, float] = field(default_factory=dict)
    _single: dict[tuple, float] = field(default_factory=dict)

    def of(self, token: Token) -> float:
        if not token.features or token.skip:
            return 0.0
        key = (token.features, bool(token.text))
        if key not in self._single:
            self._single[key] = self._of_one(*key)
        return self._single[key] * (token.words if token.text else 1)

    def _of_one(self, features: tuple[str, ...], word: bool) -> float:
        found = [self.known[f] for f in features if f in self.known]
        if not found:
            return WORD_WEIGHT if word else TAG_WEIGHT
        low, high = WORD_BOUNDS if word else TAG_BOUNDS
        return min(max(sum(found) / len(found), low), high)

    def of_name(self, name: str) -> float:
        """Mean weight of the parts of a class, role or id."""
        parts = _parts(name)
        own = [min(self.known.get(f"part {p}", 0.0), SPOKEN_OF if p in _speaks else 0.0) for p in parts]
        return sum(own) / len(own) if own else 0.0


@dataclass(slots=True)
class Token:
    """A piece of text or a tag. Its weight is looked up by its `features`."""

    features: tuple[str, ...]
    text: str = ""  # of a piece of text, decoded
    words: int = 0
    breaks: bool = False  # a tag that ends a block
    space: bool = False  # a line break inside a block
    label: bool = False  # inside a labelled article
    skip: bool = False  # inside a block that is never article
    parts: tuple[str, ...] = ()  # of the names of the container that a piece of text is in


@dataclass(slots=True)
class _Open:
    name: str
    block: int  # place of the nearest block on the stack, this one included
    blocks: int  # blocks on the stack up to here
    label: bool
    skip: bool
    words: tuple[str, ...]  # features of words in here
    parts: tuple[str, ...]


def _names(attributes: str) -> list[tuple[str, str]]:
    """(class, role or id; one name of it)."""
    if not attributes:
        return []
    pairs = ((m[1].lower(), m[2] or m[3] or m[4] or "") for m in _attribute.finditer(attributes))
    return [(key, name) for key, value in pairs if key in ("class", "id", "role") for name in value.split()]


def _is_never(name: str, names: list[tuple[str, str]], label: bool, weights: Weights) -> bool:
    """Whether an element is never article. An id says so only as a whole, and inside a
    labelled article not at all: there it names what a section is about."""
    if name in _never:
        return True
    if name not in _containers:
        return False
    limits = {"class": NEVER_WEIGHT, "role": NEVER_WEIGHT, "id": -LIMIT if label else SPOKEN_OF}
    return any(weights.of_name(own) <= limits[key] for key, own in names)


def _tag_end(page: str, at: int, last: dict[str, int]) -> int:
    """Where a tag that starts before `at` ends, after its `>`; values in quotes may hold one."""
    while True:
        m = _stop.search(page, at)
        if m is None:
            return len(page)
        if not m[1]:
            return m.end()
        # A quote that is never closed is a character like others.
        at = page.index(m[1], m.end()) + 1 if last[m[1]] >= m.end() else m.end()


def tokens(page: str | None, weights: Weights | None = None) -> Iterator[Token]:
    """Tokens of a page; malformed markup is read as far as it goes, never fails."""
    page, weights = page or "", weights or Weights()
    last = {c: page.rfind(c) for c in "<>\"'"}
    at, stack = 0, [_Open("", 0, 0, False, False, ("word",), ())]
    places: dict[str, list[int]] = defaultdict(list)  # of open elements on the stack, by name
    known: dict[tuple[str, bool], tuple[str, ...]] = {}
    unclosed: set[str] = set()  # raw elements without an end tag from here on

    def text(piece: str) -> Iterator[Token]:
        if piece:
            piece, top = html.unescape(piece), stack[-1]
            yield Token(top.words, piece, len(piece.split()), label=top.label, skip=top.skip, parts=top.parts)

    def close(depth: int) -> None:
        for x in stack[depth:]:
            places[x.name].pop()
        del stack[depth:]

    begun = 0  # of text that is not yet given out
    while at <= last["<"]:
        start = page.find("<", at)
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            end = len(page) if end < 0 else end + 3
        elif page.startswith(("<!", "<?"), start):
            end = page.find(">", start) + 1 if last[">"] > start else 0
        else:
            m = _name.match(page, start + 1)
            end = _tag_end(page, m.end(), last) if m and last[">"] > start else 0
            end = 0 if end and page[end - 1] != ">" else end
        if not end:  # a bare <
            at = start + 1
            continue
        yield from text(page[begun:start])
        at = begun = end
        if page[start + 1] in "!?":
            continue
        closing = page[start + 1] == "/"
        name = m[0].strip("/").lower()
        attributes = page[m.end() : end - 1]
        if name in _raw and not closing:
            if name in unclosed or (name in FOREIGN and attributes.endswith("/") and not _open_value.search(attributes)):
                continue
            found = _raw_end[name].search(page, at)
            if found:
                at = begun = found.end()
            elif name in ENDLESS:
                at = begun = len(page)
            else:
                unclosed.add(name)
            continue
        top, skip = stack[-1], stack[-1].skip
        if closing:
            if places[name]:
                depth = places[name][-1]
                # An end tag closes what is open inside; one of a phrase closes no block.
                if name in _blocks or top.blocks == stack[depth - 1].blocks:
                    skip = stack[depth].skip
                    close(depth)
            label = stack[-1].label
        else:
            names = _names(attributes)
            if name in _blocks:  # a new block ends an open paragraph
                nearest = stack[top.block]
                if nearest.name == "p" or nearest.name == name == "li":
                    close(top.block)
            top = stack[-1]
            label, skip = top.label, top.skip or _is_never(name, names, top.label, weights)
            if name not in _void and not attributes.endswith("/"):
                block = name in _blocks
                places[name].append(len(stack))
                inside = label or name in LABELS
                words = (f"word {name}", *(("word in article",) if inside else ())) if block else top.words
                parts = tuple(p for _, own in names for p in _parts(own)) if name in _containers and names else top.parts
                stack.append(
                    _Open(name, len(stack) if block else top.block, top.blocks + block, inside, skip, words, parts)
                )
        if (features := known.get((name, label))) is None:
            features = () if name in LABELS else (f"tag {name}", *(("tag in article",) if label else ()))
            known[name, label] = features
        yield Token(features, breaks=name in _blocks, space=name == "br", label=label, skip=skip)
    yield from text(page[begun:])


def best_region(page_tokens: list[Token], weights: Weights) -> tuple[int, int]:
    """Ends [start, end) of the run of greatest sum; the longest of equals, then the first."""
    best, total, start, region = 0.0, 0.0, 0, (0, 0)
    for k, token in enumerate(page_tokens):
        total += weights.of(token)
        if total < 0:
            total, start = 0.0, k + 1
        elif total > best or (total == best and region[1] and start == region[0]):
            best, region = total, (start, k + 1)
    return region


def main_text(page: str | None, weights: Weights) -> str:
    """Blocks of the best region, white space turned into single spaces, joined by \\n."""
    found = list(tokens(page, weights))
    start, end = best_region(found, weights)
    blocks, block = [], []
    for token in found[start:end]:
        if token.breaks:
            blocks.append(" ".join("".join(block).split()))
            block = []
        elif token.space:
            block.append(" ")
        elif token.text and not token.skip:
            block.append(token.text)
    blocks.append(" ".join("".join(block).split()))
    return "\n".join(b for b in blocks if b)


def count_features(pages: list[str | None]) -> dict[str, list[int]]:
    """Tokens by feature: [outside, inside] of labelled articles; pages without one count nothing."""
    total: dict[str, list[int]] = defaultdict(lambda: [0, 0])
    for page in pages:
        own: Counter = Counter()
        for token in tokens(page):
            inside = token.label and not token.skip
            for feature in (*token.features, *(f"part {p}" for p in token.parts)):
                own[feature, inside] += token.words if token.text else 1
        if any(inside for _, inside in own):
            for (feature, inside), n in own.items():
                total[feature][inside] += n
    return total


def fit(pages: DataFrame, html_col: str = "html", sample_pages: int = SAMPLE_PAGES, most_features: int = 20_000) -> Weights:
    """Weights from `sample_pages` distinct pages, chosen by hash, as far as they label their
    article themselves (an <article> or <main> element); the `most_features` most frequent."""
    chosen = sample_texts(pages, html_col, sample_pages)

    def count(batches):
        for batch in batches:
            found = count_features(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_pydict(
                {
                    "feature": pa.array(list(found), pa.string()),
                    "outside": pa.array([v[0] for v in found.values()], pa.int64()),
                    "inside": pa.array([v[1] for v in found.values()], pa.int64()),
                }
            )

    counted = chosen.mapInArrow(count, "feature string, outside long, inside long")
    counted = counted.groupBy("feature").agg(F.sum("outside").alias("outside"), F.sum("inside").alias("inside"))
    rows = counted.orderBy(F.desc(F.col("outside") + F.col("inside")), "feature").limit(most_features).collect()
    known = {}
    for r in rows:
        # Odds of one feature by itself: how much more often it is inside than outside.
        odds = math.log((r["inside"] + 0.5) / (r["outside"] + 0.5))
        known[r["feature"]] = max(-LIMIT, min(LIMIT, odds))
    return Weights(known)


def extract(
    pages: DataFrame, weights: Weights, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """page_id, url, text, n_chars of every input row, from the whole html.

    A null or empty page, or one without a region of positive sum, has an empty text.
    Repeated rows and null ids are rows like others; other columns are not looked at.
    """
    pages = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html")
    )
    schema = T.StructType(
        [pages.schema["page_id"], pages.schema["url"], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    )

    def read(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = [main_text(h.as_py(), weights) for h in part.column(2)]
                columns = [part.column(0), part.column(1), pa.array(texts, pa.string())]
                columns.append(pa.array([len(t) for t in texts], pa.int64()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return pages.mapInArrow(read, schema)
