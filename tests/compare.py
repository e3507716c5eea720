"""Compare a Spark query with its SQL twin, as multisets of rows with columns by name."""

from __future__ import annotations

from collections import Counter
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf: str):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, Decimal):
        return int(v) if v == v.to_integral_value() else float(v)
    if isinstance(v, float) and v == int(v):
        return int(v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(df, con, sql):
    """None if equal, else a short account."""
    cursor = con.execute(sql)
    want_cols = [d[0] for d in cursor.description]
    want = rows_of(want_cols, cursor.fetchall())
    if sorted(df.columns) != sorted(want_cols):
        return f"columns {sorted(df.columns)} != {sorted(want_cols)}"
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if got == want:
        return None
    extra, missing = list((got - want).items())[:3], list((want - got).items())[:3]
    return f"rows {sum(got.values())} vs {sum(want.values())}\n  spark only {extra}\n  sql only   {missing}"
