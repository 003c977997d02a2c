"""Compare queries with their SQL on the same tables, as the outside check does."""

from __future__ import annotations

import datetime
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return str(v)
    return f"{type(v).__name__}:{v}" if v is not None else "null"


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql: str) -> str:
    """Empty if columns and rows agree, else the first difference."""
    cur = con.execute(sql)
    want_cols = [c[0] for c in cur.description]
    want = _rows(want_cols, cur.fetchall())
    got = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if sorted(spark_df.columns) != sorted(want_cols):
        return f"columns {sorted(spark_df.columns)} != {sorted(want_cols)}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}; {got[:2]} {want[:2]}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if not got:
        return "no rows"
    return f"{len(bad)} of {len(got)} rows differ: {bad[0]}" if bad else ""
