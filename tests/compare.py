"""Run a registered query and its DuckDB statement on the same tables and compare the rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def duckdb_on(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return con


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(normal(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both sides agree, else a description of the first difference."""
    result = con.execute(sql)
    expected = rows_of([d[0] for d in result.description], result.fetchall())
    actual = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if expected[0] != actual[0]:
        return f"columns {actual[0]} instead of {expected[0]}"
    if len(expected[1]) != len(actual[1]):
        return f"{len(actual[1])} rows instead of {len(expected[1])}"
    for mine, theirs in zip(actual[1], expected[1]):
        if mine != theirs or [type(v) for v in mine] != [type(v) for v in theirs]:
            cells = [(c, m, t) for c, m, t in zip(actual[0], mine, theirs) if m != t or type(m) is not type(t)]
            return f"first differing row: {cells}"
    return None
