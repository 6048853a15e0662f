"""Order-insensitive comparison of a Spark result with a DuckDB result."""

import datetime
import decimal
import math

import duckdb

from ledgerlake.plans.fixtures import TABLES


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canonical(v):
    if v is None or isinstance(v, (bool, str)):
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v + 0.0) if math.isinf(v) else f"{v + 0.0:.9g}"
    if isinstance(v, int):
        return f"{float(v):.9g}" if abs(v) < 2**31 else str(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(canonical(r[i]) for i in order) for r in data]
    return sorted(columns), sorted(out, key=repr)


def difference(df, con, sql):
    """None when both agree, else a short description."""
    got_cols, got = rows(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(sql)
    want_cols, want = rows([d[0] for d in res.description], res.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}; first {got[:2]} / {want[:2]}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} rows differ, e.g. {bad[:2]}" if bad else None
