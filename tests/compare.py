"""Compare registered queries with their SQL, as sorted rows."""

import datetime as dt
import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def cell(v):
    if v is None:
        return "~"
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, (float, Decimal)):
        return f"{float(v):.6f}"
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return f"{type(v).__name__}:{v}"


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in data), sorted(names)


def spark_rows(df):
    return rows(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cur = con.execute(sql)
    return rows([d[0] for d in cur.description], cur.fetchall())
