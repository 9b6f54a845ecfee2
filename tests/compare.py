"""Run a named query and its SQL twin and compare schema, row count and values."""

from __future__ import annotations

import math
import re
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
SAME_TYPE = {
    "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
    "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean",
}


def duck(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def is_ordered(sql: str) -> bool:
    """Whether the statement as a whole has an ORDER BY, not just a part of it."""
    while (shorter := re.sub(r"\([^()]*\)", "", sql)) != sql:
        sql = shorter
    return "ORDER BY" in sql


def _sortable(row):
    return tuple((v is not None, str(v)) for v in row)


def difference(con, df, sql: str) -> str | None:
    """What differs, or None. Rows are compared in order if the SQL orders them."""
    result = con.execute(sql)
    theirs = {d[0]: str(d[1]) for d in result.description}
    ours = dict(df.dtypes)
    if set(theirs) != set(ours):
        return f"columns {sorted(ours)} != {sorted(theirs)}"
    types = {c: (ours[c], theirs[c]) for c in ours if SAME_TYPE.get(theirs[c]) != ours[c]}
    names = sorted(ours)
    at = [list(theirs).index(c) for c in names]
    expected = [tuple(r[i] for i in at) for r in result.fetchall()]
    # Columns are put in order here: a select on top could let Spark plan anew.
    actual = [tuple(r[c] for c in names) for r in df.collect()]
    if not is_ordered(sql):
        expected, actual = sorted(expected, key=_sortable), sorted(actual, key=_sortable)
    if len(expected) != len(actual):
        return f"{len(actual)} rows != {len(expected)}"
    for e, a in zip(expected, actual, strict=True):
        if e != a and not all(x == y or (isinstance(x, float) and math.isnan(x)) for x, y in zip(e, a, strict=True)):
            return f"{dict(zip(names, a))} != {dict(zip(names, e))}"
    return f"types {types}" if types else None


def main(folder: str, wanted: list[str]) -> int:
    import __spark_entry__ as entry
    from tillhouse.session import local_session

    spark, con = local_session(), duck(folder)
    sql, bad = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = fn(spark, folder)
            problem = difference(con, df, sql[name]) if name in sql else f"no SQL; {df.count()} rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'DIFF'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
