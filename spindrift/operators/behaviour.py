"""Behaviour features of users over their sessions and page views.

Each is one aggregation on the user, so Spark combines before the shuffle. Ties: the most common value is the smallest
of the most frequent; the last used is the largest at the latest time (NULL if all are NULL then).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindrift.functions import device, scalars

CATEGORIES = ["mobile", "desktop", "TV", "tablet"]


def last_used(value: str, ts: str) -> Column:
    c = F.col(value)
    return F.max_by(c, F.struct(F.col(ts), c.isNotNull(), c))


def most_common(value: str) -> Column:
    return F.mode(F.col(value), True)


def device_shares(sessions: DataFrame) -> DataFrame:
    counts = {c: F.count_if(F.col("device_category") == c) for c in CATEGORIES}
    rows = sessions.groupBy("user_id").agg(*[v.alias(f"_{c}") for c, v in counts.items()])
    whole = scalars.total([F.col(f"_{c}") for c in CATEGORIES])
    return rows.select("user_id", *[F.round(F.try_divide(F.col(f"_{c}"), whole), 1).alias(f"{c.lower()}_share") for c in CATEGORIES])


def categories(sessions: DataFrame) -> DataFrame:
    fields = {"device_type": "device_category", "browser": "browser_name", "os": "os_name"}
    return sessions.groupBy("user_id").agg(*[f(v).alias(f"{k}_{n}") for k, v in fields.items() for n, f in (("most_common", most_common), ("last_used", lambda v: last_used(v, "session_start")))])


def device_counts(sessions: DataFrame) -> DataFrame:
    rows = sessions.fillna("unknown", ["os_name", "device_category", "device_brand_name"])
    known = F.when(F.col("device_category") != "unknown", F.col("device_category"))
    return rows.groupBy("user_id").agg(F.count_distinct(known).alias("n_device_categories"), F.count_distinct("os_name", "device_category", "device_brand_name").alias("n_devices"))


def web_statistics(sessions: DataFrame) -> DataFrame:
    span = F.date_diff(F.max("session_start"), F.min("session_start")) + 1
    duration = F.unix_timestamp("session_end") - F.unix_timestamp("session_start")
    return sessions.groupBy("user_id").agg(F.round(F.avg(duration)).alias("avg_seconds"), F.lit(1).alias("active"), F.round(F.tanh(1 / span), 2).alias("security_affinity"))


def visit_periods(sessions: DataFrame) -> DataFrame:
    rows = sessions.withColumn("period", scalars.visit_period(F.hour("session_start")))
    return rows.groupBy("user_id").agg(most_common("period").alias("period_most_common"))


def page_view_misc(views: DataFrame) -> DataFrame:
    rows = views.withColumn("engine", device.grouped_engine("search_engine"))
    return rows.groupBy("user_id").agg(
        most_common("engine").alias("engine_most_common"), last_used("engine", "ts").alias("engine_last_used"), F.count("*").alias("n_views"),
        F.array_join(F.array_sort(F.collect_set("owner_name")), ",").alias("owner_names"),
    )


def web_visits(views: DataFrame, word: str = "blog") -> DataFrame:
    return views.where(~F.col("url_normalized").contains(word)).groupBy("user_id").agg(F.count_distinct("ts").alias("n_visits"))


def days_since(views: DataFrame, as_of: str, word: str = "blog") -> DataFrame:
    """Days since the last view of a page with the word; NULL for users without one."""
    ago = F.date_diff(F.lit(as_of).cast("date"), F.to_date("ts"))
    return views.groupBy("user_id").agg(F.min(F.when(F.col("url_normalized").contains(word), ago)).alias("days_since"))
