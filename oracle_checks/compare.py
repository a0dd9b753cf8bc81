"""Local stand-in for the driver's correctness check.

Runs a registered Spark query and its DuckDB oracle on the same Parquet
tables and compares row count, column names and an order-insensitive
multiset of normalised rows.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duckdb_conn(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int,)):
        return float(v)
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat() + " 00:00:00"
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ")
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return str(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> dict:
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out = {
        "name": name,
        "rows_spark": len(s_rows),
        "rows_oracle": len(d_rows),
        "cols_match": sorted(s_cols) == sorted(d_cols),
    }
    out["values_match"] = out["cols_match"] and _rows(s_cols, s_rows) == _rows(d_cols, d_rows)
    if not out["cols_match"]:
        out["cols"] = (sorted(s_cols), sorted(d_cols))
    elif not out["values_match"]:
        a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
        diff_a = [r for r in a if r not in set(b)][:3]
        diff_b = [r for r in b if r not in set(a)][:3]
        out["only_spark"] = diff_a
        out["only_oracle"] = diff_b
    return out
