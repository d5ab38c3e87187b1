"""Order-insensitive comparison of a Spark result with DuckDB oracle SQL."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math

import duckdb

from millrace.sources.tables import DRIVER_TABLES, table_path


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def norm(v, places=6):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        if math.isnan(f):
            return "nan"
        r = round(f, places)
        return 0.0 if r == 0 else r
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "asDict"):
        return norm(v.asDict(), places)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x, places) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x, places)) for k, x in v.items()))
    return v


def canon(columns, rows, places=6):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = sorted((tuple(norm(r[i], places) for i in order) for r in rows), key=repr)
    return cols, out


def digest(rows) -> str:
    h = hashlib.sha256()
    for r in rows:
        h.update(repr(r).encode())
    return h.hexdigest()[:16]


def compare(spark_df, con, sql, places=6):
    s_cols, s_rows = canon(spark_df.columns, spark_df.collect(), places)
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_cols, d_rows = canon(d_cols, res.fetchall(), places)
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "columns_match": s_cols == d_cols, "values_match": s_rows == d_rows}
    if not out["columns_match"]:
        out["spark_cols"], out["oracle_cols"] = s_cols, d_cols
    elif not out["values_match"]:
        ss, dd = set(s_rows), set(d_rows)
        out["only_spark"] = sorted(ss - dd, key=repr)[:3]
        out["only_oracle"] = sorted(dd - ss, key=repr)[:3]
    out["ok"] = out["columns_match"] and out["values_match"]
    return out
