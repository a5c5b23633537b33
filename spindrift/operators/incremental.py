"""Increments: high-water marks, upserts, new keys and retention over plain Parquet."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookback(df: DataFrame, column: str, as_of: str | dt.date, days: int, include_end: bool = False) -> DataFrame:
    """Rows of [as_of - days, as_of), or with the last day too. A date predicate that reaches the partitions."""
    end = dt.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    day = F.col(column)
    after = day >= F.lit(end - dt.timedelta(days=days))
    return df.where(after & (day <= F.lit(end) if include_end else day < F.lit(end)))


def high_water(df: DataFrame, date: str, ts: str, last_days: int = 20, as_of: str | dt.date | None = None):
    """Latest timestamp within the last days, or None for an empty table."""
    if as_of is not None:
        df = lookback(df, date, as_of, last_days, include_end=True)
    return df.agg(F.max(ts)).first()[0]


def since(df: DataFrame, date: str, ts: str, mark: DataFrame, safety_days: int = 0, first_days: int = 7, as_of: str = "") -> DataFrame:
    """Rows after a high-water mark (a one-row table with column ``mark``): the date prunes partitions, the timestamp
    decides. Without a mark, the last ``first_days`` before ``as_of``."""
    m = F.col("mark").cast("timestamp") - F.expr(f"INTERVAL '{safety_days}' DAY")
    new = (F.col(date) >= F.to_date(m)) & (F.col(ts) > m)
    start = F.col("mark").isNull() & (F.col(date) >= F.lit(dt.date.fromisoformat(as_of) - dt.timedelta(days=first_days))) if as_of else F.col("mark").isNull()
    return df.crossJoin(F.broadcast(mark.limit(1))).where(new | start).drop("mark")


def new_keys(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    return df.join(known.select(key).distinct(), key, "left_anti")


def first_rows(df: DataFrame, key: str, order: list[str], columns: list[str]) -> DataFrame:
    """One row a key: its count and, for each column, the first value that is not NULL in a total order."""
    place = F.struct(*order)
    return df.groupBy(key).agg(F.count("*").alias("n"), *[F.min_by(c, F.when(F.col(c).isNotNull(), place)).alias(c) for c in columns])


def duplicates(df: DataFrame, key: str | list[str]) -> DataFrame:
    """The keys of more than one row, with their number of rows ``n``."""
    return df.groupBy(*([key] if isinstance(key, str) else key)).agg(F.count("*").alias("n")).where("n > 1")


def has_duplicates(df: DataFrame, key: str | list[str]) -> bool:
    return not duplicates(df, key).isEmpty()


def upsert(base: DataFrame, updates: DataFrame, key: str | list[str], check: bool = True) -> DataFrame:
    """Updates replace rows of the same key and add the others. A key twice in the updates is an error."""
    keys = [key] if isinstance(key, str) else key
    if check and has_duplicates(updates, keys):
        raise ValueError("updates hold a key twice")
    return base.join(updates.select(*keys), keys, "left_anti").unionByName(updates)


def keep_days(df: DataFrame, date: str, days: int, least: int = 0) -> DataFrame:
    """Rows not older than the table's latest date less ``max(days, least)``. The latest date is one row, joined."""
    latest = df.agg(F.max(date).alias("_latest"))
    return df.crossJoin(F.broadcast(latest)).where(F.col(date) >= F.date_sub("_latest", max(days, least))).drop("_latest")


def already_run(df: DataFrame, timestamp: Column) -> bool:
    return not df.where(F.col("timestamp") == timestamp).isEmpty()
