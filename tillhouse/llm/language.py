"""Language identification by nearest centroids of TF-IDF n-gram vectors.

Byte bigrams and trigrams of the lower-cased letters of a whole text are counted in
SIZE hashed places, damped, weighted by inverse document frequency and normalised.
Each language has several centroids, clustered from its labelled texts; the nearest
by cosine decides, and a text farther from it than nearly all of its own labelled
texts were is marked as rejected. The model is fitted on a bounded sample of the
labelled rows; every text is classified.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tillhouse.llm.shared import stored

SIZE = 4096
#: Bound on the distinct labelled texts of a language that the model is fitted on.
PER_LANGUAGE = 1000
CLUSTERS = 4
ROUNDS = 12
#: Share of a cluster's own labelled texts that would be rejected.
REJECTED_SHARE = 0.002
UNKNOWN = "und"

#: A letter, for Spark; `str.isalpha` asks for the same categories.
LETTER = r"\p{L}"
_fold = np.full(256, 32, dtype=np.uint8)
_fold[[*range(97, 123), *range(128, 256)]] = [*range(97, 123), *range(128, 256)]
_AT_ONCE = 1 << 20


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def counts(text: str) -> np.ndarray:
    """Hashed counts of the n-grams of a text, float32."""
    raw = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), dtype=np.uint8)
    found = np.zeros(SIZE, dtype=np.float32)
    for start in range(0, len(raw), _AT_ONCE):
        b = _fold[raw[start : start + _AT_ONCE + 2]].astype(np.uint32)
        b = np.concatenate(([32], b, [32])).astype(np.uint32) if start == 0 else b
        keep = np.ones(len(b), dtype=bool)  # runs of other characters count as one space
        keep[1:] = (b[1:] != 32) | (b[:-1] != 32)
        b = b[keep]
        twos = b[:-1] << np.uint32(8) | b[1:]
        threes = twos[:-1] << np.uint32(8) | b[2:]
        for grams in (twos | np.uint32(1 << 24), threes):
            places = (grams * np.uint32(2654435761)) >> np.uint32(20)
            found += np.bincount(places, minlength=SIZE).astype(np.float32)
    return found


def weighted(rows: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit TF-IDF vectors of rows of counts; rows of zeros stay so."""
    v = np.log1p(rows) * idf
    norms = np.linalg.norm(v, axis=1, keepdims=True)
    return v / np.where(norms > 0, norms, 1)


@dataclass(frozen=True)
class Centroids:
    languages: list[str]  # of each centroid
    vectors: np.ndarray
    floors: np.ndarray  # least cosine that is not rejected
    idf: np.ndarray

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid and its cosine, for rows of counts."""
        cosines = weighted(rows, self.idf) @ self.vectors.T
        best = cosines.argmax(axis=1)
        return best, cosines[np.arange(len(rows)), best]


def clusters(v: np.ndarray, number: int = CLUSTERS, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means of unit vectors, started from far-apart ones; centroids and members."""
    starts = [0]
    nearest = v @ v[0]
    while len(starts) < min(number, len(v)):
        k = int(nearest.argmin())
        if nearest[k] > 1 - 1e-6:
            break
        starts.append(k)
        nearest = np.maximum(nearest, v @ v[k])
    centroids = v[starts]
    for _ in range(rounds):
        member = (v @ centroids.T).argmax(axis=1)
        sums = np.stack([v[member == k].sum(axis=0) for k in range(len(centroids))])
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(norms > 0, sums / np.where(norms > 0, norms, 1), centroids).astype(np.float32)
    return centroids, (v @ centroids.T).argmax(axis=1)


def sample_of(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> DataFrame | None:
    """(lang, text): the `per_language` distinct texts of each language with the least hashes,
    all where it has no more; None without any. Rows without a language or a letter do not count."""
    rows = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").rlike(LETTER))
    rows = rows.withColumn("place", F.shiftrightunsigned(F.xxhash64("text"), 1))
    known = stored(rows.select("lang", "place").distinct(), "language-texts")
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}  # one row a language
    if not sizes:
        return None

    def of(values: dict[str, int]):
        return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[F.col("lang")]

    # Surely enough of the least hashes, then the last of those wanted: no task ranks a whole language.
    top, enough = (1 << 63) - 1, per_language + 10 * int(per_language**0.5) + 10
    least = known.filter(F.col("place") <= of({lang: top if n <= enough else top * enough // n for lang, n in sizes.items()}))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place"))
    last = least.withColumn("rank", rank).filter(F.col("rank") <= per_language).groupBy("lang").agg(F.max("place").alias("last"))
    last = {r["lang"]: r["last"] for r in last.collect()}
    return rows.filter(F.col("place") <= of(last)).groupBy("lang", "place").agg(F.min("text").alias("text")).select("lang", "text")


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> Centroids:
    """Centroids from `per_language` distinct texts of each language, chosen by hash.

    Rows without a language or a letter do not count.
    """
    sample = sample_of(labelled, text_col, lang_col, per_language)
    if sample is None:
        return Centroids([], np.zeros((0, SIZE), np.float32), np.zeros(0), np.ones(SIZE, np.float32))

    def vectors(batches):
        for batch in batches:
            lang, text = batch.column(0), batch.column(1)
            use = [k for k in range(batch.num_rows) if has_letter(text[k].as_py())]
            own = [counts(text[k].as_py()).tobytes() for k in use]
            yield pa.RecordBatch.from_arrays(
                [lang.take(pa.array(use, pa.int64())), pa.array(own, pa.binary())], names=["lang", "counts"]
            )

    def matrix(pdf: pd.DataFrame) -> np.ndarray:
        pdf = pdf.sort_values("counts")
        return np.frombuffer(b"".join(pdf["counts"]), dtype=np.float32).reshape(len(pdf), SIZE)

    sample = stored(sample.mapInArrow(vectors, "lang string, counts binary"), "language-sample")

    def frequencies(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"n": [len(pdf)], "df": [(matrix(pdf) > 0).sum(axis=0).astype("int64").tolist()]})

    found = sample.groupBy("lang").applyInPandas(frequencies, "n long, df array<long>").collect()
    total = sum(r["n"] for r in found)
    df = np.sum([r["df"] for r in found], axis=0) if found else np.zeros(SIZE)
    idf = (np.log((1 + total) / (1 + df)) + 1).astype(np.float32)

    def centroids(pdf: pd.DataFrame) -> pd.DataFrame:
        v = weighted(matrix(pdf), idf).astype(np.float32)
        vectors, member = clusters(v)
        own = [(v[member == k] @ c) for k, c in enumerate(vectors)]
        floors = [float(np.quantile(x, REJECTED_SHARE)) if len(x) else 0.0 for x in own]
        return pd.DataFrame(
            {"lang": pdf["lang"].iloc[0], "floor": floors, "vector": [c.astype("<f4").tobytes() for c in vectors]}
        )

    model = sample.groupBy("lang").applyInPandas(centroids, "lang string, floor double, vector binary").collect()
    model.sort(key=lambda r: (r["lang"], r["vector"]))
    return Centroids(
        [r["lang"] for r in model],
        np.stack([np.frombuffer(bytes(r["vector"]), dtype="<f4") for r in model]) if model else np.zeros((0, SIZE), np.float32),
        np.array([r["floor"] for r in model]),
        idf,
    )


def classify(docs: DataFrame, model: Centroids, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, rejected of every input row, from its whole text alone.

    A text that is null or has no letter is `und` with score 0, as are all without a
    model. Repeated rows and null ids are rows like others; other columns are not
    looked at. The score is the cosine with the nearest centroid.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("rejected", T.BooleanType()),
        ]
    )

    def predict(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 128):
                part = batch.slice(start, 128)
                texts = part.column(1).to_pylist()
                known = [k for k, t in enumerate(texts) if has_letter(t) and model.languages]
                lang, score, rejected = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), dtype=bool)
                if known:
                    best, cosine = model.nearest(np.stack([counts(texts[k]) for k in known]))
                    score[known] = np.clip(cosine, 0, 1)
                    rejected[known] = cosine < model.floors[best]
                    for k, b in zip(known, best, strict=True):
                        lang[k] = model.languages[b]
                columns = [part.column(0), pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return docs.mapInArrow(predict, schema)


def held_out(id_col: str = "doc_id"):
    """Whether a row is kept from training: crc32 of the id as text, modulo 3, is 1."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 3 == 1
