"""Row-for-row comparison of a Spark query with its SQL counterpart."""

from __future__ import annotations

import math
import re
from collections import Counter

import duckdb

TYPES = {
    "VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET threads = 8")
    for table in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _cell(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)):
        return "nan" if isinstance(v, float) and math.isnan(v) else float(v)
    return str(v)


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> list[str]:
    """What differs between the DataFrame and the SQL: names, types, rows."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: TYPES.get(re.sub(r"\(.*", "", str(d[1])), str(d[1])) for d in result.description}
    found = []
    if sorted(names) != sorted(df.columns):
        found.append(f"columns {sorted(df.columns)} != {sorted(names)}")
        return found
    types = {n: (k, kinds[n]) for n, k in df.dtypes if k != kinds[n]}
    if types:
        found.append(f"types {types}")
    ours, theirs = bag(df.columns, df.toLocalIterator()), bag(names, result.fetchall())
    if ours != theirs:
        more, less = ours - theirs, theirs - ours
        found.append(f"rows {sum(ours.values())} vs {sum(theirs.values())}, {sum(more.values())} differ")
        found.append(f"columns {sorted(names)}")
        found.append(f"ours   {list(more)[:3]}")
        found.append(f"theirs {list(less)[:3]}")
    elif not ours:
        found.append("EMPTY")
    return found
