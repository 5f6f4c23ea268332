"""Compare a Spark query with DuckDB SQL over the same Parquet tables, rows in any order."""

import datetime
import decimal
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(x):
    if isinstance(x, decimal.Decimal):
        x = float(x)
    if isinstance(x, bool):
        return int(x)
    if isinstance(x, float):
        return None if math.isnan(x) else float(f"{x:.9g}")
    if isinstance(x, (datetime.datetime, datetime.date)):
        return str(x)
    if isinstance(x, (list, tuple)):
        return tuple(map(plain, x))
    return x


def rows_of_spark(df):
    names = sorted(df.columns)
    return names, sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr)


def rows_of_sql(con, sql):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    order = sorted(range(len(cols)), key=cols.__getitem__)
    return [cols[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in cur.fetchall()), key=repr)
