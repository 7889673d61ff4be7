"""Compare a query with its SQL, the way the driver does: columns by name, rows as a multiset."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter
from pathlib import Path

import duckdb


def norm(v):
    if isinstance(v, float):
        return round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def connect(d: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    for p in Path(d).glob("*.parquet"):
        at = f"{p}/*.parquet" if p.is_dir() else p
        c.execute(f"create view {p.stem} as select * from read_parquet('{at}')")
    return c


def compare(spark, name, f, sql, d) -> str:
    """Empty if equal, else what differs."""
    df = f(spark, d)
    cols = sorted(df.columns)
    got = Counter(tuple(norm(r[c]) for c in cols) for r in df.collect())
    res = connect(d).execute(sql)
    names = [x[0] for x in res.description]
    if sorted(names) != cols:
        return f"{name}: columns {cols} against {sorted(names)}"
    order = [names.index(c) for c in cols]
    want = Counter(tuple(norm(r[i]) for i in order) for r in res.fetchall())
    if got != want:
        a, b = got - want, want - got
        return f"{name}: {sum(got.values())} rows against {sum(want.values())}; only Spark {list(a)[:3]}; only SQL {list(b)[:3]}"
    return ""
