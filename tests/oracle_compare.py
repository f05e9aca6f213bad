"""Side-by-side compare of a Spark query with its DuckDB SQL (row count,
column names, order-insensitive values)."""

from __future__ import annotations

import datetime as _dt
import decimal as _dec
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(round(v, 9))
    if isinstance(v, _dec.Decimal):
        return repr(round(float(v), 9))
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, _dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    return str(v)


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    vals = sorted(tuple(_norm(r[i]) for i in order) for r in rows)
    return cols, vals


def compare(spark_df, con, sql):
    s_rows = [tuple(r) for r in spark_df.collect()]
    s_cols = spark_df.columns
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    sc, sv = canon(s_cols, s_rows)
    dc, dv = canon(d_cols, d_rows)
    problems = []
    if sc != dc:
        problems.append(f"columns {sc} != {dc}")
    if len(sv) != len(dv):
        problems.append(f"rows {len(sv)} != {len(dv)}")
    elif sv != dv:
        diff = [(a, b) for a, b in zip(sv, dv) if a != b][:3]
        problems.append(f"values differ, e.g. {diff}")
    return problems, len(sv)
