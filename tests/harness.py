"""Side-by-side run of the registered queries and their SQL twins."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def oracle_rows(sf_dir: str, sql: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    rows = cursor.fetchall()
    con.close()
    return columns, rows


def compare(df, sf_dir: str, sql: str) -> str | None:
    """None when equal, else what differs."""
    got_rows = [tuple(r) for r in df.collect()]
    columns, want_rows = oracle_rows(sf_dir, sql)
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    got, want = sorted_rows(df.columns, got_rows), sorted_rows(columns, want_rows)
    if len(got) != len(want):
        extra = [r for r in got if r not in set(want)][:2] if len(got) < 20000 else ""
        return f"{len(got)} rows, expected {len(want)}; e.g. {extra}"
    for g, w in zip(got, want):
        if g != w:
            names = sorted(columns)
            return "; ".join(f"{n}: {a!r} != {b!r}" for n, a, b in zip(names, g, w) if a != b)[:600]
    return None
