"""Runs a registered query and its SQL over the same tables and compares the results."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_value(r[i]) for i in order) for r in rows), key=lambda r: tuple(str(x) for x in r))


_KINDS = {
    "tinyint": "TINYINT", "smallint": "SMALLINT", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
    "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def compare(df, con, sql) -> list[str]:
    """Empty when names, types, row count and values agree."""
    cur = con.execute(sql)
    want_names = [d[0] for d in cur.description]
    want_types = {d[0]: str(d[1]) for d in cur.description}
    want = _rows(want_names, cur.fetchall())
    problems = []
    if sorted(df.columns) != sorted(want_names):
        return [f"columns {sorted(df.columns)} != {sorted(want_names)}"]
    for name, kind in df.dtypes:
        if _KINDS.get(kind, kind) != want_types[name]:
            problems.append(f"type of {name}: {kind} != {want_types[name]}")
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    if got != want:
        diff = next(((g, w) for g, w in zip(got, want) if g != w), None)
        problems.append(f"first difference (columns {sorted(df.columns)}): {diff}")
    if not want:
        problems.append("empty result proves nothing")
    return problems
