"""Runs a query in Spark and its SQL in DuckDB and compares rows, columns by name, in any order."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf: str):
    c = duckdb.connect()
    for p in glob.glob(f"{sf}/*.parquet"):
        src = f"{p}/*.parquet" if os.path.isdir(p) else p
        c.execute(f"create view {os.path.basename(p).removesuffix('.parquet')} as select * from '{src}'")
    return c


def value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "-"
    if isinstance(v, bool) or not isinstance(v, (int, float)):
        return str(v)
    return f"{v:.10g}"


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(value(r[i]) for i in order) for r in rows)


def compare(spark, con, name, query, sql, sf):
    df = query(spark, sf)
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    theirs = rows_of(names, got.fetchall())
    assert sorted(df.columns) == sorted(names), (name, df.columns, names)
    assert len(ours) == len(theirs), (name, len(ours), len(theirs))
    bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
    assert not bad, (name, len(bad), bad[:3])
    return len(ours)
