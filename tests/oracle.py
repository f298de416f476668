"""Compares a query with its SQL on the test tables."""

import glob
import math
import os

import duckdb


def connect(folder):
    con = duckdb.connect()
    for p in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v.isoformat() if hasattr(v, "isoformat") else v


def table(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return [columns[i] for i in order], sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def same(spark, con, folder, query, sql):
    df = query(spark, folder)
    got = table(df.columns, df.collect())
    found = con.execute(sql)
    want = table([c[0] for c in found.description], found.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]
