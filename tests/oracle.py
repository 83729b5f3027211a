"""Comparison of a query with its SQL on the same tables."""

import math
import os


def connect(folder):
    import duckdb

    con = duckdb.connect()
    for t in os.listdir(folder):
        p = f"{folder}/{t}" + ("/*.parquet" if os.path.isdir(f"{folder}/{t}") else "")
        con.execute(f"CREATE VIEW {t.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.8g}")
    if isinstance(v, (list, tuple)):
        return tuple(map(norm, v))
    if type(v).__name__ == "Decimal":
        return norm(float(v)) if v % 1 else int(v)
    return v


def same(x, y):
    if isinstance(x, tuple) and isinstance(y, tuple):
        return len(x) == len(y) and all(map(same, x, y))
    if isinstance(x, (int, float)) and isinstance(y, (int, float)):
        return math.isclose(x, y, rel_tol=1e-6, abs_tol=1e-9)
    return x == y


def check(df, con, sql):
    cols = sorted(df.columns)
    mine = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    theirs = sorted((tuple(norm(r[names.index(c)]) for c in cols) for r in cur.fetchall()), key=repr)
    assert len(mine) == len(theirs)
    assert all(map(same, mine, theirs))
