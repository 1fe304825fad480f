"""Local compare harness: run a registered Spark query and its DuckDB oracle on the same Parquet
tables and compare row count, column names/types and the multiset of rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    import os
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v, digits):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, digits) if digits is not None else v
    if isinstance(v, decimal.Decimal):
        return round(float(v), digits) if digits is not None else float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__) if x is not None else "", x if x is not None else 0) for x in row)


def compare(spark_df, con, sql: str, digits: int | None = None) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_types = [str(c[1]) for c in cur.description]
    d_rows = cur.fetchall()
    res = {"spark_rows": len(s_rows), "duck_rows": len(d_rows),
           "cols_match": sorted(s_cols) == sorted(d_cols)}
    if not res["cols_match"]:
        res["spark_cols"], res["duck_cols"] = s_cols, d_cols
        return res
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    d_index = {c: i for i, c in enumerate(d_cols)}
    s_types = dict(spark_df.dtypes)
    res["types"] = {c: (s_types[c], d_types[d_index[c]]) for c in sorted(s_cols)}
    a = sorted((tuple(_norm(r[i], digits) for i in order) for r in s_rows), key=_key)
    b = sorted((tuple(_norm(r[d_index[s_cols[i]]], digits) for i in order) for r in d_rows), key=_key)
    res["values_match"] = a == b
    if not res["values_match"]:
        diff_a = [x for x in a if x not in set(b)][:3]
        diff_b = [x for x in b if x not in set(a)][:3]
        res["cols"] = [s_cols[i] for i in order]
        res["only_spark"], res["only_duck"] = diff_a, diff_b
    return res
