"""Runs a registered query and its DuckDB equivalent and compares the rows."""

import glob
import os

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if glob.glob(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and v != v) or v is pd.NaT:
        return None
    if isinstance(v, (list, tuple)) or hasattr(v, "tolist") and getattr(v, "ndim", 0):
        return tuple(_cell(x) for x in v)
    if isinstance(v, float):
        return round(v, 6) + 0.0
    if hasattr(v, "item"):
        return _cell(v.item())
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime()
    return v


def rows(columns: list[str], data) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in data), key=repr)


def difference(spark_df, con, sql: str) -> str:
    """Empty if the columns and rows agree."""
    got = rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    rel = con.sql(sql)
    want = rows(rel.columns, rel.fetchall())
    if sorted(spark_df.columns) != sorted(rel.columns):
        return f"columns {sorted(spark_df.columns)} and {sorted(rel.columns)}"
    if got != want:
        bad = next(((a, b) for a, b in zip(got, want) if a != b), None)
        return f"{len(got)} and {len(want)} rows; {bad}"
    return ""
