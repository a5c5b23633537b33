"""Feature tables: assembly of stages, the latest snapshot, and segments by SQL predicates."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

KEYS = ["user_id", "timestamp"]


def fill_for(column: str, templates: dict[str, object]) -> object | None:
    """Fill value of the first template that matches; {name} in a template stands for any word."""
    for template, value in templates.items():
        if re.fullmatch(re.sub(r"\\{[^}]*\\}", "[^/]+", re.escape(template)), column):
            return value
    return None


def assemble(frames: list[DataFrame], templates: dict[str, object]) -> DataFrame:
    """All features of all users: a full outer join on the keys, NULLs filled as the templates say."""
    out = frames[0]
    for f in frames[1:]:
        out = out.join(f, KEYS, "full_outer")
    fills = {c: v for c in out.columns if c not in KEYS and (v := fill_for(c, templates)) is not None}
    return out.fillna(fills) if fills else out


def latest(df: DataFrame, key: str = "user_id", ts: str = "timestamp") -> DataFrame:
    """Each entity's row of its latest time, by one combining aggregate."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(ts, F.xxhash64(*rest))).alias("r")).select(key, "r.*")


def segment(features: DataFrame, predicate: str, name: str, key: str = "user_id") -> tuple[DataFrame, DataFrame]:
    """Members of a segment by an SQL predicate over features, and a log row."""
    members = features.where(F.expr(predicate)).select(key, F.lit(name).alias("segment"))
    return members, members.agg(F.lit(name).alias("segment"), F.count("*").alias("n"))


def counted(df: DataFrame, name: str, **conditions) -> tuple[DataFrame, Observation]:
    """The frame, with its row count (and counts of conditions) observed as it is next written: no job of its own."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(k) for k, c in conditions.items()]), seen


def columns_like(df: DataFrame, pattern: str) -> list[str]:
    """Names of the columns that begin with a match of ``pattern``, in the frame's order."""
    return [c for c in df.columns if re.match(pattern, c)]
