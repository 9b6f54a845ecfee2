"""Roles, permissions, row scope and the audit trail."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import all_of, field, optional_equal, pg_asc, pg_desc
from ..operators import newest_first, page

ADMIN = "admin"


def _keys_by_role(role_permissions: DataFrame, permissions: DataFrame) -> DataFrame:
    """Sorted permission keys of each role that has any: as long as the list of
    permissions at most, whatever the number of users."""
    named = permissions.select(F.col("id").alias("permission_id"), "key")
    return (
        role_permissions.join(named, "permission_id")
        .groupBy("role_id")
        .agg(F.array_sort(F.collect_set("key")).alias("permissions"))
    )


def role_permissions(roles: DataFrame, bridge: DataFrame, permissions: DataFrame) -> DataFrame:
    """Every role with its permissions; an empty list where it has none."""
    keys = _keys_by_role(bridge, permissions)
    return (
        roles.join(keys, F.col("id") == F.col("role_id"), "left")
        .select("id", "name", "description", F.coalesce("permissions", F.array().cast("array<string>")).alias("permissions"))
        .orderBy(pg_asc("id"))
    )


def permission_list(permissions: DataFrame) -> DataFrame:
    return permissions.select("id", "key", "label").orderBy(pg_asc("key"))


def permissions_of_role(bridge: DataFrame, permissions: DataFrame, role_id: int) -> DataFrame:
    wanted = bridge.filter(F.col("role_id") == role_id).select(F.col("permission_id").alias("id"))
    return permissions.join(wanted, "id").select("id", "key", "label")


def user_permissions(users: DataFrame, roles: DataFrame, bridge: DataFrame, permissions: DataFrame) -> DataFrame:
    """Active users with the permissions of their role. Users whose role has no
    permission are left out. Lists are built per role, then joined to users."""
    granted = roles.select(F.col("id").alias("role_id"), F.col("name").alias("role")).join(
        _keys_by_role(bridge, permissions), "role_id"
    )
    return (
        users.filter(F.col("active"))
        .join(granted, "role_id")
        .select(F.col("id").alias("user_id"), "role", "store_id", "permissions")
    )


def visible_to(inventory: DataFrame, users: DataFrame, roles: DataFrame, user_id: int) -> DataFrame:
    """The stock rows one user may see: an administrator all, others their store's.

    The user's scope is looked up once and becomes a filter on the stock scan.
    """
    me = (
        users.filter(F.col("id") == user_id)
        .join(roles.select(F.col("id").alias("role_id"), F.col("name").alias("role")), "role_id")
        .select("role", "store_id")
    )
    is_admin = me.select(F.col("role") == ADMIN).scalar()
    own_store = me.select("store_id").scalar()
    return inventory.filter(is_admin | (F.col("store_id") == own_store)).withColumn("user_id", F.lit(user_id).cast("long"))


def visible_inventory(inventory: DataFrame, users: DataFrame, roles: DataFrame, user_ids: Sequence[int]) -> DataFrame:
    """The stock rows that each of some users may see, from one scan of the stock: a row
    meets the users of its store in one join and the administrators as a list."""
    named = roles.select(F.col("id").alias("role_id"), F.col("name").alias("role"))
    asked = users.filter(F.col("id").isin(list(user_ids))).join(named, "role_id")
    admins = asked.filter(F.col("role") == ADMIN).agg(F.collect_list(F.col("id").cast("long")).alias("ids")).scalar()
    by_store = asked.filter(F.col("role") != ADMIN).groupBy("store_id").agg(F.collect_list(F.col("id").cast("long")).alias("_users"))
    seen_by = F.concat(admins, F.coalesce("_users", F.array().cast("array<bigint>")))
    rows = inventory.join(by_store, "store_id", "left").select(*[inventory[c] for c in inventory.columns], seen_by.alias("_users"))
    return rows.select(*inventory.columns, F.explode("_users").alias("user_id"))


def visible_totals(inventory: DataFrame, users: DataFrame, roles: DataFrame) -> DataFrame:
    """How much stock each user may see. Stock is summed per store before users
    are joined, so no (user, stock row) pair is ever made."""
    rows, units = F.count(F.lit(1)).alias("_rows"), F.sum("quantity").alias("_units")
    per_store = inventory.groupBy("store_id").agg(rows, units)
    # Both sums in one value, so that it needs the same columns as the join below.
    overall = F.struct(F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"), F.sum("_units").alias("units"))
    everything = per_store.agg(overall.alias("all")).scalar()
    all_rows, all_units = everything["rows"], everything["units"]
    named = users.join(roles.select(F.col("id").alias("role_id"), F.col("name").alias("role")), "role_id")
    scoped = named.join(per_store, "store_id", "left")
    admin, nothing = F.col("role") == ADMIN, F.lit(0)
    return scoped.select(
        F.col("id").alias("user_id"),
        "role",
        F.when(admin, all_rows).otherwise(F.coalesce("_rows", nothing)).alias("visible_rows"),
        F.when(admin, F.coalesce(all_units, nothing)).otherwise(F.coalesce("_units", nothing)).alias("visible_quantity"),
    )


def may_access(df: DataFrame, role: str, own_store: int | None, requested: str = "requested_store") -> DataFrame:
    """Requests that pass the store check: administrators, requests for no store
    in particular, and requests for the own store."""
    if role == ADMIN:
        return df
    return df.filter(F.col(requested).isNull() | (F.col(requested) == own_store))


def user_list(users: DataFrame, roles: DataFrame) -> DataFrame:
    """Users with their role, newest first."""
    named = roles.select(F.col("id").alias("role_id"), F.col("name").alias("role"))
    return users.join(named, "role_id").select("id", "name", "email", "active", "role_id", "role").orderBy(pg_desc("id"))


def role_of(emails: DataFrame, employees: DataFrame, default: str = "STAFF") -> DataFrame:
    """The role for each e-mail address; ``default`` for unknown ones."""
    known = employees.select("email", F.col("role").alias("_role"))
    return emails.join(known, "email", "left").select("email", F.coalesce("_role", F.lit(default)).alias("role"))


def audit_log_search(
    audit: DataFrame, users: DataFrame, *,
    user_id: int | None = None, action: str | None = None, table_name: str | None = None,
    start: dt.datetime | None = None, end: dt.datetime | None = None, limit: int = 100, offset: int = 0,
) -> DataFrame:
    """Newest audit rows that match, with who did it. The user join cannot change
    the number of rows and therefore follows the limit."""
    wanted = all_of(
        [
            optional_equal("user_id", user_id, zero_means_all=True),
            optional_equal("action", action, zero_means_all=True),
            optional_equal("table_name", table_name, zero_means_all=True),
            None if start is None else F.col("created_at") >= F.lit(start),
            None if end is None else F.col("created_at") <= F.lit(end),
        ]
    )
    top = page(audit.filter(wanted), [pg_desc("created_at"), pg_desc("id")], limit, offset)
    people = users.select(F.col("id").alias("_user"), F.col("name").alias("user_name"), F.col("email").alias("user_email"))
    labelled = top.join(people, F.col("user_id") == F.col("_user"), "left").drop("_user")
    return newest_first(labelled, "created_at", "id")


def normalize_profiles(profiles: DataFrame) -> DataFrame:
    """Employee rows of identity-provider sign-ups, with defaults for what the
    loose JSON lacks."""
    meta = "raw_user_meta_data"
    return profiles.select(
        "id",
        field(meta, "employee_code", F.concat(F.lit("EMP-"), F.substring("id", 1, 8))).alias("employee_code"),
        field(meta, "name", F.col("email")).alias("name"),
        field(meta, "role", F.lit("STAFF")).alias("role"),
        field(meta, "branch_id", as_type="int").alias("branch_id"),
        "email",
    )
