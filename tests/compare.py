"""Compare a Spark result with the DuckDB result of its SQL."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# DuckDB types accepted for each Spark type.
TYPES = {
    "bigint": {"BIGINT"},
    "int": {"INTEGER"},
    "double": {"DOUBLE"},
    "string": {"VARCHAR"},
    "boolean": {"BOOLEAN"},
    "timestamp_ntz": {"TIMESTAMP"},
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, bool) or value is None:
        return repr(value)
    if isinstance(value, float):
        return repr(value) if math.isfinite(value) else str(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con, sql) -> list[str]:
    """What differs; an empty list when the results are the same."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()
    found = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for name, kind in df.dtypes:
        if types[name].upper() not in TYPES.get(kind, {kind.upper()}):
            found.append(f"type of {name}: {kind} != {types[name]}")
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    want = rows_of(names, expected)
    if len(got) != len(want):
        found.append(f"{len(got)} rows != {len(want)}")
    if got != want:
        pairs = [(g, w) for g, w in zip(got, want) if g != w][:2]
        found.append(f"values differ, e.g. {pairs}")
    return found
