"""Compare a registered query with its SQL twin, strictly and without regard to row order."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from millrace.registry import QUERIES, TABLE_NAMES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLE_NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return value + 0.0 if value else 0.0
    if isinstance(value, decimal.Decimal):
        return ("dec", str(value))
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    if isinstance(value, (bytes, bytearray)):
        return bytes(value)
    return value


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=repr)


def duck_rows(con, sql):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    rows = cur.fetchall()
    return [cols[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name: str, folder: str) -> str | None:
    """None when both sides agree, else a short description of the difference."""
    got_cols, got = spark_rows(QUERIES[name](spark, folder))
    want_cols, want = duck_rows(con, QUERIES[name].sql)
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}; only spark {[r for r in got if r not in want][:2]}; only sql {[r for r in want if r not in got][:2]}"
    bad = [(g, w) for g, w in zip(got, want) if g != w or repr(g) != repr(w)]
    return f"{len(bad)} rows differ, e.g. {bad[0]}" if bad else None
