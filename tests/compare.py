"""Comparison of a query's rows with those of its SQL on another engine."""

import math

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def sql_rows(sql: str, folder: str) -> pd.DataFrame:
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return c.execute(sql).df()


def plain(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(float(v), 6)
    if hasattr(v, "year"):
        return str(v)[:10]
    return int(v) if hasattr(v, "__index__") else v


def rows(df: pd.DataFrame) -> tuple[list[str], list[tuple]]:
    df = df.reindex(sorted(df.columns), axis=1)
    return list(df.columns), sorted((tuple(map(plain, r)) for r in df.itertuples(index=False)), key=repr)
