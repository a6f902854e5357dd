"""Run registered queries and their SQL on the same tables and compare."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def sql_rows(folder: str, sql: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    found = con.execute(sql)
    columns = [d[0] for d in found.description]
    return columns, found.fetchall(), [str(d[1]) for d in found.description]


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda r: tuple((v is not None, str(type(v)), v) if not isinstance(v, bool) else (True, "b", v) for v in r))


def difference(df, folder: str, sql: str) -> str | None:
    """None when both give the same rows, else what differs."""
    columns, expected, types = sql_rows(folder, sql)
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} but SQL has {sorted(columns)}"
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    want = _rows(columns, expected)
    spark_types = {n: t for n, t in df.dtypes}
    if len(got) != len(want):
        return f"{len(got)} rows but SQL has {len(want)}: {got[:2]} / {want[:2]}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    kinds = {c: (spark_types[c], t) for c, t in zip(columns, types)}
    return f"{len(bad)} of {len(got)} rows differ, first {bad[:2]}; types {kinds}" if bad else None
