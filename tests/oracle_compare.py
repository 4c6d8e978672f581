"""Run a Spark DataFrame and a DuckDB query and compare them like the
driver does: same column names, same row count, same multiset of rows
(order-insensitive).  Floats compare after rounding to 9 significant
digits; NaN equals NaN."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents "
                 "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return float(f"{v:.9g}")
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "is_finite"):  # Decimal
        return float(f"{float(v):.9g}")
    return v


def rows_of_spark(df):
    cols = df.columns
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    rows = [tuple(_norm(r[i]) for i in order) for r in df.collect()]
    return [cols[i] for i in order], rows


def rows_of_duck(con, sql):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    rows = [tuple(_norm(r[i]) for i in order) for r in cur.fetchall()]
    return [cols[i] for i in order], rows


def compare(df, con, sql) -> dict:
    sc, sr = rows_of_spark(df)
    dc, dr = rows_of_duck(con, sql)
    res = {"spark_rows": len(sr), "oracle_rows": len(dr), "cols_match": sc == dc}
    cs, cd = Counter(map(repr, sr)), Counter(map(repr, dr))
    res["values_match"] = res["cols_match"] and cs == cd
    if not res["values_match"]:
        res["spark_cols"], res["oracle_cols"] = sc, dc
        res["only_spark"] = list((cs - cd).elements())[:3]
        res["only_oracle"] = list((cd - cs).elements())[:3]
    return res
