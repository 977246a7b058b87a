"""Runs a registered query and its SQL, and compares columns, types and values."""

from __future__ import annotations

import datetime
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Spark type -> DuckDB type.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET threads TO 4")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def _sorted(rows):
    return sorted(([_cell(v) for v in row] for row in rows), key=lambda r: [(v is None, str(v)) for v in r])


def difference(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    result = con.execute(sql)
    theirs = {d[0]: str(d[1]) for d in result.description}
    their_rows = result.fetchall()
    ours = dict(df.dtypes)
    if sorted(ours) != sorted(theirs):
        return f"columns {sorted(ours)} != {sorted(theirs)}"
    wrong = {c: (ours[c], theirs[c]) for c in ours if TYPES.get(ours[c]) != theirs[c]}
    if wrong:
        return f"types {wrong}"
    order = sorted(ours)
    position = {name: i for i, name in enumerate(theirs)}
    left = _sorted([r[c] for c in order] for r in df.collect())
    right = _sorted([r[position[c]] for c in order] for r in their_rows)
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            return f"{dict(zip(order, a))} != {dict(zip(order, b))}"
    return None
