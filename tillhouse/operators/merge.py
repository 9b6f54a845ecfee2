"""Set-based table maintenance: the effect of INSERT / UPDATE / DELETE statements
on a whole batch of rows, as DataFrame -> DataFrame functions.

Every function shuffles each side once, on the key. Callers write the result
with ``tillhouse.sinks``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import keep_first


def insert_absent(base: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The rows of ``new`` to append: keys that ``base`` lacks, first row per key.

    ``order`` names columns of ``new`` that say which duplicate comes first;
    they are dropped from the result.
    """
    firsts = keep_first(new, keys, [F.col(c) for c in order]).drop(*order)
    return firsts.join(base.select(*keys), list(keys), "left_anti")


def upsert(base: DataFrame, new: DataFrame, keys: Sequence[str], replace: Sequence[str]) -> DataFrame:
    """Insert new keys; replace ``replace`` columns, also with NULL, on known keys.

    Columns of ``base`` that are not replaced keep their value and are NULL on
    inserted rows. ``new`` must have one row per key.
    """
    incoming = new.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in replace], F.lit(True).alias("_given"))
    merged = base.join(incoming, list(keys), "full_outer")
    columns = [
        F.when(F.col("_given"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in replace else F.col(c)
        for c in base.columns
    ]
    return merged.select(*columns)


def update_from(
    base: DataFrame, changes: DataFrame, keys: Sequence[str], assign: Mapping[str, Column]
) -> DataFrame:
    """UPDATE base SET … FROM changes: rows without a match stay as they are.

    Expressions in ``assign`` may use columns of both sides; columns of
    ``changes`` must not clash with those of ``base``.
    """
    extra = [c for c in changes.columns if c not in keys]
    joined = base.join(changes.withColumn("_hit", F.lit(True)), list(keys), "left")
    columns = [
        F.when(F.col("_hit"), assign[c]).otherwise(F.col(c)).alias(c) if c in assign else F.col(c)
        for c in base.columns
    ]
    return joined.select(*columns, *extra).drop(*extra)


def update_where(base: DataFrame, condition: Column, assign: Mapping[str, Column]) -> DataFrame:
    """UPDATE base SET … WHERE condition. A NULL condition leaves the row alone."""
    return base.withColumns({c: F.when(condition, v).otherwise(F.col(c)) for c, v in assign.items()})


def patch(
    base: DataFrame, delta: DataFrame, key: str, columns: Sequence[str], stamp: Mapping[str, Column] | None = None
) -> DataFrame:
    """Partial update: NULL in ``delta`` means "not supplied". ``stamp`` columns
    (an update time, say) are set on every row that ``delta`` names."""
    assign = {c: F.coalesce(F.col(f"_p_{c}"), F.col(c)) for c in columns} | dict(stamp or {})
    renamed = delta.select(key, *[F.col(c).alias(f"_p_{c}") for c in columns])
    return update_from(base, renamed, [key], assign)


def replace_children(
    base: DataFrame, new: DataFrame, parent: str, parents: DataFrame | None = None
) -> DataFrame:
    """Give each named parent exactly the children in ``new``.

    ``parents`` names the parents to replace; it is needed only when some get
    an empty set, as those have no row in ``new``.
    """
    touched = (new if parents is None else parents).select(parent).distinct()
    return base.join(touched, parent, "left_anti").unionByName(new.select(*base.columns).distinct())


def delete_cascade(children: DataFrame, deleted: DataFrame, foreign_key: str, key: str = "id") -> DataFrame:
    """The child rows left after their parents are deleted. Chain for deeper levels."""
    gone = deleted.select(F.col(key).alias("_gone")).distinct()
    return children.join(gone, F.col(foreign_key) == F.col("_gone"), "left_anti")


def delete_set_null(children: DataFrame, deleted: DataFrame, foreign_key: str, key: str = "id") -> DataFrame:
    """The child rows after ON DELETE SET NULL: all kept, the reference cleared."""
    gone = deleted.select(F.col(key).alias("_gone")).distinct()
    kept = F.when(F.col("_gone").isNull(), F.col(foreign_key))
    joined = children.join(gone, F.col(foreign_key) == F.col("_gone"), "left")
    return joined.withColumn(foreign_key, kept).drop("_gone")
