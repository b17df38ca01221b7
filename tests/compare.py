"""Order-insensitive comparison of a Spark DataFrame with a DuckDB result."""

from __future__ import annotations

import decimal
import math

import duckdb

from sqlcheck.compose import register_driver_views


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v.to_integral_value() else str(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def duck(sf_dir: str):
    con = duckdb.connect()
    register_driver_views(con, sf_dir)
    return con


def compare(df, sql: str, sf_dir: str, con=None) -> tuple[bool, str]:
    con = con or duck(sf_dir)
    rel = con.execute(sql)
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    scols = df.columns
    srows = [tuple(r) for r in df.collect()]
    if sorted(c.lower() for c in scols) != sorted(c.lower() for c in dcols):
        return False, f"columns differ: spark={sorted(scols)} duck={sorted(dcols)}"
    # align case-insensitively
    s = _rows([c.lower() for c in scols], srows)
    d = _rows([c.lower() for c in dcols], drows)
    if len(s) != len(d):
        return False, f"row count spark={len(s)} duck={len(d)}"
    bad = [(a, b) for a, b in zip(s, d) if a != b]
    if bad:
        return False, f"{len(bad)} rows differ, e.g. spark={bad[0][0]} duck={bad[0][1]}"
    return True, f"{len(s)} rows match"
