"""Compares a query with its SQL, as sorted rows under the same column names."""

import glob
import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def oracle(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = f"{folder}/{t}.parquet"
        if os.path.isdir(path):
            path += "/*.parquet"
        if glob.glob(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return con


def cell(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    if isinstance(x, bool):
        return x
    if isinstance(x, float):
        return round(x, 6)
    if hasattr(x, "isoformat"):
        return x.replace(tzinfo=None).isoformat() if hasattr(x, "hour") else x.isoformat()
    return x


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(cell(r[i]) for i in order) for r in data), key=repr)


def differences(df, con, sql, show=3):
    """[] if both give the same rows."""
    got = rows(df.columns, df.collect())
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    want = rows(names, cur.fetchall())
    if sorted(names) != sorted(df.columns):
        return [("columns", sorted(df.columns), sorted(names))]
    if got == want:
        return []
    a, b = set(map(repr, got)), set(map(repr, want))
    return [("rows", len(got), len(want)), *sorted(a - b)[:show], "--", *sorted(b - a)[:show]]
