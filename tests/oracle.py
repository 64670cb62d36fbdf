"""Runs DuckDB SQL over a folder of Parquet tables and compares rows with a DataFrame, whatever the order."""

import os

import duckdb


def connect(folder):
    con = duckdb.connect()
    for f in os.listdir(folder):
        p = f"{folder}/{f}"
        con.execute(f"create view {f.split('.')[0]} as select * from '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return con


def _norm(v):
    return round(v, 9) if isinstance(v, float) else v


def same(df, con, sql):
    cur = con.execute(sql)
    names = sorted(x[0] for x in cur.description)
    order = [[x[0] for x in cur.description].index(n) for n in names]
    want = sorted((tuple(_norm(r[k]) for k in order) for r in cur.fetchall()), key=repr)
    assert sorted(df.columns) == names
    got = sorted((tuple(_norm(r[n]) for n in names) for r in df.collect()), key=repr)
    assert got == want
