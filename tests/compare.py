"""Compare a Spark result with the same query in a second engine."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as from '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, int):
        return repr(float(value)) if abs(value) < 2**53 else str(value)
    return str(value)


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(df, con, sql, limit=5) -> list[str]:
    cur = con.execute(sql)
    want_names, want = as_rows([d[0] for d in cur.description], cur.fetchall())
    names, got = as_rows(df.columns, [tuple(r) for r in df.collect()])
    if names != want_names:
        return [f"columns {names} != {want_names}"]
    out = []
    if len(got) != len(want):
        out.append(f"{len(got)} rows != {len(want)}")
    extra, missing = list(set(got) - set(want)), list(set(want) - set(got))
    for label, rows in (("spark only", extra), ("sql only", missing)):
        out += [f"{label}: {dict(zip(names, r))}" for r in sorted(rows)[:limit]]
    if not out and got != want:
        out.append("same rows, other multiplicities")
    return out
