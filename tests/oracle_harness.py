"""Spark-vs-DuckDB comparison in the spirit of the driver's correctness gate:
same column names, same row count, same multiset of rows (floats compared
after rounding to 9 significant digits)."""

from __future__ import annotations

import math
import os
from decimal import Decimal

import duckdb

# 9 by default; ORACLE_FLOAT_DIGITS=17 compares doubles exactly
FLOAT_DIGITS = int(os.environ.get("ORACLE_FLOAT_DIGITS", "9"))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "<null>"
    if isinstance(v, float):
        if math.isnan(v):
            return "<null>"
        if v == 0:
            return "0"
        return f"{v:.{FLOAT_DIGITS}g}"
    if isinstance(v, Decimal):
        return f"{float(v):.9g}"
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows), [columns[i] for i in order]


def compare(spark_df, con, sql: str):
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    sr, sc = rows_of(s_cols, s_rows)
    dr, dc = rows_of(d_cols, d_rows)
    problems = []
    if sc != dc:
        problems.append(f"columns differ: spark={sc} duck={dc}")
    if len(sr) != len(dr):
        problems.append(f"row counts differ: spark={len(sr)} duck={len(dr)}")
    if not problems and sr != dr:
        diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        problems.append(f"values differ, e.g. {diff}")
    return problems, len(sr)
