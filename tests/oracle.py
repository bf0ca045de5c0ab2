"""Compares a query with its DuckDB SQL over one folder of tables."""

import os

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def plain(x):
    if isinstance(x, float):
        return None if x != x else round(x, 6)
    if hasattr(x, "tolist"):
        return plain(x.tolist())
    if isinstance(x, (list, tuple)):
        return tuple(plain(y) for y in x)
    if isinstance(x, dict):
        return tuple(plain(x[k]) for k in sorted(x))
    if hasattr(x, "asDict"):
        return plain(x.asDict())
    if x is None or x is pd.NaT:
        return None
    return x


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def assert_same(df, sql, sf_dir):
    want = connect(sf_dir).execute(sql)
    names = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(names)
    a, b = rows_of(df.columns, df.collect()), rows_of(names, want.fetchall())
    assert len(a) == len(b), (len(a), len(b))
    bad = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
    assert not bad, bad[:3]
    return len(a)
