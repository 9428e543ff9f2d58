"""Comparison of a query with its SQL in DuckDB over the same Parquet files."""

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, int | float):
        return round(float(v), 9)
    return str(v)


def rows_of(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=str)


def rows_of_sql(con, sql):
    rel = con.sql(sql)
    cols = sorted(rel.columns)
    at = [rel.columns.index(c) for c in cols]
    return cols, sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=str)
