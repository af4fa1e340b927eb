"""Compares queries with their SQL on DuckDB: columns by name, rows in any order, values exactly."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def value(x):
    if isinstance(x, float):
        return None if math.isnan(x) else (int(x) if x == int(x) else float(f"{x:.12g}"))
    if isinstance(x, list):
        return tuple(map(value, x))
    if isinstance(x, bool) or not hasattr(x, "is_integer"):
        return x
    return value(float(x))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(columns), Counter(tuple(value(r[k]) for k in order) for r in rows)


def connection(sf_dir: str):
    con = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    return con


def differences(df, sql: str, con) -> str:
    """Empty if equal, else what differs."""
    cur = con.execute(sql)
    want_cols, want = rows_of([c[0] for c in cur.description], cur.fetchall())
    got_cols, got = rows_of(df.columns, df.collect())
    if got_cols != want_cols:
        return f"columns {got_cols} instead of {want_cols}"
    if got != want:
        return f"{sum(got.values())} rows, {sum(want.values())} wanted; only here {list((got - want).items())[:3]}; only there {list((want - got).items())[:3]}"
    return ""
