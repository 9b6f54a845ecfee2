"""What several operators need: word patterns, `let`, stored intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Separators of words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once per row, however often it occurs."""
    return F.element_at(F.transform(F.array(value), body), 1)


def text_or_empty(text: Column | str) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    """Array of the words of a text; null has none."""
    return F.array_remove(F.split(text_or_empty(text), SPACE + "+"), "")


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names like `names` that do not clash with columns of `df`, in any case."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        new, k = f"_{name}", 0
        while new.lower() in taken:
            k += 1
            new = f"_{name}{k}"
        taken.add(new.lower())
        found.append(new)
    return found


_own_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; a local one only where none is set."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    application = spark.sparkContext.applicationId
    if application not in _own_folders:
        _own_folders[application] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _own_folders[application]


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame, written to the shared folder and read back: cuts its lineage there."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sample_texts(df: DataFrame, text_col: str, number: int) -> DataFrame:
    """(text): the `number` distinct texts with the least hashes, all where there are no
    more; nulls are none. However many copies a text has, it counts once, so the sample
    is neither lost among copies nor longer than its bound."""
    place = F.shiftrightunsigned(F.xxhash64(text_col), 1)
    rows = df.filter(F.col(text_col).isNotNull()).select(F.col(text_col).cast("string").alias("text"), place.alias("place"))
    known = stored(rows.select("place").distinct(), "sampled-texts")
    size, enough = known.count(), number + 10 * int(number**0.5) + 10
    if size > number:
        # Surely enough of the least, then the last of those wanted.
        near = known.filter(F.col("place") <= (((1 << 63) - 1) * enough // size if size > enough else (1 << 63) - 1))
        last = near.orderBy("place").limit(number).agg(F.max("place")).first()[0]
        rows = rows.filter(F.col("place") <= last)
    return rows.groupBy("place").agg(F.min("text").alias("text")).select("text")
