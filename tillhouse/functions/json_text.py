"""JSON held in string columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_json_array(
    df: DataFrame, column: str, fields: Mapping[str, str], position: str | None = None
) -> DataFrame:
    """One row per element of a JSON array of objects; other columns are kept.

    ``fields`` maps field names to types. Values are read as text and then cast,
    so "11" and 11 are the same; one that does not cast is NULL. ``position``
    names a column for the element's place in its array.
    """
    others = [c for c in df.columns if c != column]
    texts = "array<struct<" + ",".join(f"`{name}`: string" for name in fields) + ">>"
    at = position or "_position"
    exploded = df.select(*others, F.posexplode(F.from_json(column, texts)).alias(at, "_item"))
    values = [F.col(f"_item.{name}").try_cast(kind).alias(name) for name, kind in fields.items()]
    return exploded.select(*others, *([at] if position else []), *values)


def unreadable(df: DataFrame, column: str) -> DataFrame:
    """Rows whose text is no JSON array of objects; ``explode_json_array`` yields
    nothing for them."""
    return df.filter(F.col(column).isNotNull() & F.from_json(column, "array<map<string,string>>").isNull())


def field(column: str, name: str, default: Column | None = None, as_type: str | None = None) -> Column:
    """A field of a JSON object, as text or cast; ``default`` where it is missing."""
    value = F.get_json_object(F.col(column), f"$.{name}")
    if as_type:
        value = value.try_cast(as_type)
    return value if default is None else F.coalesce(value, default)
