"""Runs the registered queries next to their SQL and compares rows, names and types."""

from __future__ import annotations

import glob
import math
import os

import duckdb

# SQL engine type -> Spark type
TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(os.path.join(folder, "*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _sortable(row):
    return tuple((v is None, str(type(v).__name__) if v is not None else "", v if v is not None else 0) for v in row)


def _same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=0, abs_tol=0) or (math.isnan(a) and math.isnan(b))
    return a == b and type(a) is type(b)


def compare(spark, con, folder: str, build, sql: str) -> str | None:
    """None if both give the same result, else what differs."""
    df = build(spark, folder)
    names = sorted(df.columns)
    ours = [tuple(r[c] for c in names) for r in df.collect()]
    cursor = con.execute(sql)
    described = {d[0]: str(d[1]) for d in cursor.description}
    rows = cursor.fetchall()
    if sorted(described) != names:
        return f"columns {names} != {sorted(described)}"
    types = dict(df.dtypes)
    wrong = {c: (types[c], described[c]) for c in names if TYPES.get(described[c]) != types[c]}
    if wrong:
        return f"types {wrong}"
    place = [list(described).index(c) for c in names]
    theirs = [tuple(r[i] for i in place) for r in rows]
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    for a, b in zip(sorted(ours, key=_sortable), sorted(theirs, key=_sortable)):
        if not all(_same(x, y) for x, y in zip(a, b)):
            return f"values {a} != {b}"
    return None
