"""Runs a registered query and its SQL over the same tables and compares the rows."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf}/{name}.parquet'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "asDict"):
        return tuple(plain(x) for x in v)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, float):
        return round(v, 6) + 0.0
    return v


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda j: columns[j])
    out = [tuple(plain(r[j]) for j in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


def spark_rows(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    result = con.execute(sql)
    return canonical([d[0] for d in result.description], result.fetchall())


def difference(df, con, sql) -> str | None:
    got_cols, got = spark_rows(df)
    want_cols, want = sql_rows(con, sql)
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if not want:
        return "no rows"
    if got != want:
        bad = [(g, w) for g, w in zip(got, want) if g != w][:2]
        extra = list(set(got) - set(want))[:2], list(set(want) - set(got))[:2]
        return f"{len(got)} rows != {len(want)} rows; first differences {bad} only ours/theirs {extra}"
    return None
