"""Compare a registered query with its oracle: columns, row count and values."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def _rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


# Types DuckDB and Spark name differently.
_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def differences(df, con, sql: str) -> str | None:
    """None where both agree, else a short account."""
    cur = con.execute(sql)
    want_cols = [d[0] for d in cur.description]
    want_types = {d[0]: str(d[1]) for d in cur.description}
    want = cur.fetchall()
    got = [tuple(r) for r in df.collect()]
    if sorted(df.columns) != sorted(want_cols):
        return f"columns {sorted(df.columns)} vs {sorted(want_cols)}"
    for name, kind in df.dtypes:
        if _TYPE.get(kind, kind) != want_types[name]:
            return f"type of {name}: {kind} vs {want_types[name]}"
    if len(got) != len(want):
        return f"{len(got)} rows vs {len(want)}"
    left, right = _rows(df.columns, got), _rows(want_cols, want)
    if left != right:
        return f"values: only here {list((left - right))[:2]}, only there {list((right - left))[:2]}"
    return None
