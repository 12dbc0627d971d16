"""Spark query vs DuckDB oracle: row count, column names, order-insensitive
value hash (columns sorted by name) - the same shape of check the driver runs."""

from __future__ import annotations

import datetime as dt
import hashlib
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


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
            return "NaN"
        return repr(float(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return [_norm(x) for x in v]
    if isinstance(v, dict):
        return {k: _norm(x) for k, x in v.items()}
    return v


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(repr([_norm(r[i]) for i in order]) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def compare(spark, sf_dir, key, fn, sql):
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_types = {c: SPARK_TO_DUCK.get(t, t) for c, t in sdf.dtypes}
    s_rows = [tuple(r) for r in sdf.collect()]
    con = duck(sf_dir)
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    d_types = dict(zip(d_cols, [str(t) for t in con.sql(sql).types]))
    out = {"key": key, "rows_spark": len(s_rows), "rows_oracle": len(d_rows),
           "cols_match": sorted(s_cols) == sorted(d_cols),
           "types_match": s_types == d_types}
    if s_types != d_types:
        out["types"] = {"spark": s_types, "oracle": d_types}
    hs, ls = digest(s_cols, s_rows)
    hd, ld = digest(d_cols, d_rows)
    out["hash_match"] = hs == hd
    if hs != hd:
        only_s = sorted(set(ls) - set(ld))[:3]
        only_d = sorted(set(ld) - set(ls))[:3]
        out["diff"] = {"spark_only": only_s, "oracle_only": only_d,
                       "s_cols": s_cols, "d_cols": d_cols}
    return out
