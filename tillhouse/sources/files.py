"""File scans with declared schemas."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import POS_EVENT

CORRUPT = "_corrupt_record"


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema else reader).load(path)


def load_tables(spark: SparkSession, folder: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """Named parquet tables of a folder, one sub-folder or file each."""
    return {name: read_table(spark, f"{folder}/{name}") for name in names}


def read_json_lake(spark: SparkSession, path: str, schema: T.StructType = POS_EVENT) -> DataFrame:
    """Raw JSON lines. A line that does not parse keeps its text in
    ``_corrupt_record``; an unreadable path is an error, never sample data."""
    with_text = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(with_text)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def split_corrupt(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that parsed, texts that did not)."""
    good = raw.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = raw.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT)
    return good, bad


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    """Names of the tables and views the catalog knows."""
    return sorted(t.name for t in spark.catalog.listTables(database))


def needs_seed(table: DataFrame) -> bool:
    """Whether a table is still empty. Reads one row at most."""
    return table.isEmpty()
