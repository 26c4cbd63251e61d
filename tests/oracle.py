"""Comparison of a query's rows with those of its SQL in DuckDB."""

import math
import os

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        con.execute(f"create view {t} as select * from '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")
    return con


def plain(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, list):
        return tuple(map(plain, v))
    if isinstance(v, bool) or not isinstance(v, (int, float)):
        return v if isinstance(v, (str, bool, tuple)) else float(v) if v.__class__.__name__ == "Decimal" else v if v is not pd.NA else None
    return round(float(v), 6) + 0.0


def rows(frame):
    names = sorted(frame.columns)
    return names, sorted((tuple(plain(v) for v in r) for r in frame[names].itertuples(index=False, name=None)), key=repr)


def same(df, con, sql):
    (names, got), (want_names, want) = rows(df.toPandas()), rows(con.execute(sql).df())
    assert names == want_names
    assert len(got) == len(want)
    assert got == want
