"""Differential check: a registered Spark query against its DuckDB oracle.

Mirrors the driver's gate: same row count, same column names, same
multiset of rows (order-insensitive).  Floats are compared after rounding
to 9 significant digits so that summation-order noise does not count.
"""

from __future__ import annotations

import datetime as _dt
import decimal
import math

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb  # only here: the library and its registry are imported where DuckDB is not installed

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, _dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    if isinstance(v, bool):
        return int(v)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), str(x)) for x in row)


def compare(spark_df, con, sql: str):
    """Return (ok, message)."""
    s_cols = list(spark_df.columns)
    s_rows = [tuple(_norm(r[c]) for c in s_cols) for r in spark_df.collect()]
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows_raw = cur.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={s_cols} duckdb={d_cols}"
    idx = [d_cols.index(c) for c in s_cols]
    d_rows = [tuple(_norm(r[i]) for i in idx) for r in d_rows_raw]
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} duckdb={len(d_rows)}"
    a, b = sorted(s_rows, key=_key), sorted(d_rows, key=_key)
    for x, y in zip(a, b):
        if x != y:
            return False, f"first differing row:\n spark ={x}\n duckdb={y}"
    return True, f"{len(s_rows)} rows equal"
