"""Runs a registered query and its SQL on the same tables and compares the rows."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(plain(row[i]) for i in order) for row in rows)


def differences(spark, query, sf_dir: str) -> list[str]:
    df = query.build(spark, sf_dir)
    got_columns, got = rows_of(df.columns, df.collect())
    if query.sql is None:
        return [] if got else ["no rows"]
    result = connect(sf_dir).execute(query.sql)
    want_columns, want = rows_of([c[0] for c in result.description], result.fetchall())
    if got_columns != want_columns:
        return [f"columns {got_columns} != {want_columns}"]
    found = [f"rows {sum(got.values())} != {sum(want.values())}"] if sum(got.values()) != sum(want.values()) else []
    found += [f"only in spark: {r}" for r in list((got - want).keys())[:3]]
    found += [f"only in sql: {r}" for r in list((want - got).keys())[:3]]
    return found
