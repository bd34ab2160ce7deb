"""Spark results against DuckDB's, without regard to row order."""

import os

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def views(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return con


def plain(v):
    if v is None or v is pd.NaT or v is pd.NA or v != v:
        return "NULL"
    if isinstance(v, float):
        return f"{v:.9g}"
    return str(int(v)) if hasattr(v, "__int__") and not isinstance(v, (bool, str)) and not hasattr(v, "year") else str(v)


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return list(frame.columns), sorted(tuple(plain(v) for v in r) for r in frame.itertuples(index=False))
