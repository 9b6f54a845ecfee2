"""Row validation and cleaning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import is_email, is_not_negative, is_whole_number, js_trim, strip_angle_brackets


def validate(df: DataFrame, rules: Mapping[str, Column], name: str = "errors") -> DataFrame:
    """Add the list of messages whose rule does not hold. NULL counts as broken.

    NULLs are taken out with array_except: unlike array_compact, it leaves the
    rules themselves in generated code.
    """
    broken = [F.when(F.coalesce(rule, F.lit(False)), None).otherwise(F.lit(message)) for message, rule in rules.items()]
    return df.withColumn(name, F.array_except(F.array(*broken), F.array(F.lit(None).cast("string"))))


def accepted(validated: DataFrame, name: str = "errors") -> DataFrame:
    return validated.filter(F.size(name) == 0).drop(name)


def rejected(validated: DataFrame, name: str = "errors") -> DataFrame:
    return validated.filter(F.size(name) > 0)


def missing_fields(df: DataFrame, required: Sequence[str], name: str = "missing") -> DataFrame:
    """Add the list of required fields that are NULL or empty."""
    return validate(df, {c: F.col(c).isNotNull() & (F.col(c).cast("string") != "") for c in required}, name)


def _given_whole(column: str) -> Column:
    """An id that is present, not zero or blank, and a whole number."""
    text = F.col(column).cast("string")
    return text.isNotNull() & ~text.isin("", "0") & is_whole_number(text)


def _whole_not_negative(column: str) -> Column:
    text = F.col(column).cast("string")
    return text.isNotNull() & is_whole_number(text) & is_not_negative(text)


def user_rules() -> dict[str, Column]:
    # Messages as the forms show them, here and in the next two.
    return {
        "Name must be at least 2 characters": F.length(js_trim(F.col("name"))) >= 2,
        "Invalid email format": is_email(F.col("email")),
        "Password must be at least 8 characters": F.length("password") >= 8,
        "Valid role_id is required": _given_whole("role_id"),
    }


def inventory_rules() -> dict[str, Column]:
    return {
        "Valid store_id is required": _given_whole("store_id"),
        "Valid product_id is required": _given_whole("product_id"),
        "Quantity must be a non-negative integer": _whole_not_negative("quantity"),
        "Low stock threshold must be a non-negative integer": F.col("low_stock").isNull()
        | _whole_not_negative("low_stock"),
    }


def ledger_rules(types: Sequence[str]) -> dict[str, Column]:
    return {
        "store_id, product_id, change_amount, type are required": F.col("store_id").isNotNull()
        & F.col("product_id").isNotNull()
        & F.col("change_amount").isNotNull()
        & F.col("type").isNotNull(),
        "type must be one of: " + ", ".join(types): F.col("type").isin(*types),
    }


def sanitize(df: DataFrame) -> DataFrame:
    """Trim every string column and take angle brackets out of it."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: strip_angle_brackets(js_trim(F.col(c))) for c in text})


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that break a uniqueness constraint, and how often they occur."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def orphans(children: DataFrame, parents: DataFrame, foreign_key: str, key: str = "id") -> DataFrame:
    """Child rows whose parent does not exist. A NULL reference is not an orphan."""
    known = parents.select(F.col(key).alias("_known"))
    given = children.filter(F.col(foreign_key).isNotNull())
    return given.join(known, F.col(foreign_key) == F.col("_known"), "left_anti")
