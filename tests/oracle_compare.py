"""Run a registered Spark query and its DuckDB oracle on the same tables and compare them the
way the driver does: column names sorted, row count, and an order-insensitive value hash."""

from __future__ import annotations

import datetime as dt
import hashlib
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (dt.date,)):
        return v.isoformat()
    if isinstance(v, bool):
        return int(v)
    return v


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def compare(spark_df, con, sql):
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out = {
        "spark_rows": len(s_rows),
        "oracle_rows": len(d_rows),
        "columns_match": sorted(s_cols) == sorted(d_cols),
        "spark_columns": sorted(s_cols),
        "oracle_columns": sorted(d_cols),
    }
    out["hash_match"] = out["columns_match"] and digest(s_cols, s_rows) == digest(d_cols, d_rows)
    if not out["hash_match"] and out["columns_match"]:
        sa = sorted(repr(tuple(_norm(r[i]) for i in sorted(range(len(s_cols)), key=lambda i: s_cols[i]))) for r in s_rows)
        da = sorted(repr(tuple(_norm(r[i]) for i in sorted(range(len(d_cols)), key=lambda i: d_cols[i]))) for r in d_rows)
        only_s = sorted(set(sa) - set(da))[:3]
        only_d = sorted(set(da) - set(sa))[:3]
        out["only_spark"] = only_s
        out["only_oracle"] = only_d
    return out
