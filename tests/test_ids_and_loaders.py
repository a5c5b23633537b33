"""Ids of sessions and views worked out again by plain code, and small loaders and writers."""

import datetime as dt
import hashlib

import xxhash
from pyspark.sql import functions as F

from spindrift.operators import incremental, interests
from spindrift.operators import sessions as S
from spindrift.sources import io


def chained(*values):
    """xxHash64 over the values' texts, each seeded with the hash before; NULL counts as a mark of its own."""
    h = 42
    for v in values:
        h = xxhash.xxh64(("\u0001" if v is None else str(v)).encode(), seed=h).intdigest()
    return h - 2**64 if h >= 2**63 else h


def test_ids(spark):
    at = dt.datetime(2024, 1, 1, 10, 0, 0, 500_000)
    fields = {"device_category": "mobile", "device_brand_name": None, "device_marketing_name": "x", "os_name": "ios", "os_version": "1", "browser_name": None}
    rows = [(k, "d", at + dt.timedelta(minutes=20 * k), f"http://e/{k}" if k != 2 else "") for k in range(4)] + [(9, "d", at + dt.timedelta(hours=3), "http://e/9")]
    df = spark.createDataFrame(rows, "event_id long, device string, ts timestamp, url string").withColumns({k: F.lit(v).cast("string") for k, v in fields.items()} | {"referrer_host": F.lit("r"), "url_normalized": F.col("url"), "owner_name": F.lit("o"), "search_engine": F.lit(None).cast("string")})
    ordered = S.order_into_sessions(df)
    sessions = {r.ordinal: r for r in S.roll_up(ordered).collect()}
    wanted = {0: chained("d", 0, *fields.values(), "2024-01-01 10:00:00.5"), 1: chained("d", 1, *fields.values(), "2024-01-01 13:00:00.5")}
    assert {k: r.session_id for k, r in sessions.items()} == wanted
    assert sessions[0].device_id == chained("mobile", None, "x") and sessions[0].os_id == chained("ios", "1") and sessions[0].browser_id == chained(None)
    views = {r.event_id: r for r in S.page_views(ordered).collect()}
    assert set(views) == {0, 1, 3, 9}
    for k, r in views.items():
        session = wanted[int(k == 9)]
        micros = int((dict((a, c) for a, _, c, _ in rows)[k] - dt.datetime(1970, 1, 1)).total_seconds() * 1_000_000)
        assert r.session_id == session and r.page_view_id == hashlib.sha256(f"{session}|{micros}|http://e/{k}|{k}".encode()).hexdigest()
    compat = {r.ordinal: r.session_id for r in S.roll_up(ordered, compat_ids=True).collect()}
    assert compat == {k: chained("d", k, *fields.values()) for k in (0, 1)}


def test_loaders_and_states(spark, tmp_path):
    for account, rows in (("one", [("0", "cz", 1), ("a", "cz", 2)]), ("two", [("b", "de", 3)])):
        spark.createDataFrame(rows, "CookieID string, country string, n int").write.parquet(f"{tmp_path}/{account}")
    got = io.read_accounts(spark, [f"{tmp_path}/one", f"{tmp_path}/two/"], known=F.col("CookieID") != "0")
    assert sorted((r.account, r.n) for r in got.collect()) == [("one", 2), ("two", 3)]
    assert io.read_accounts(spark, [f"{tmp_path}/one", f"{tmp_path}/two"], known=F.col("CookieID") != "0", place=F.col("country") == "de").count() == 1
    state = spark.createDataFrame([("m", 0.5)], "model string, share double")
    for day in ("2024-01-01", "2024-01-02"):
        io.append_last_used(state, f"{tmp_path}/used", day)
    used = spark.read.parquet(f"{tmp_path}/used")
    assert used.count() == 2 and used.agg(F.max("run_date")).first()[0] == dt.date(2024, 1, 2)
    runs = used.withColumn("timestamp", F.col("run_date"))
    assert incremental.already_run(runs, F.lit("2024-01-02").cast("date")) and not incremental.already_run(runs, F.lit("2024-01-03").cast("date"))
    wide = interests.wide(spark.createDataFrame([("u", "a", 0.25), ("u", "b", 0.5), ("v", "b", 1.0)], "user_id string, interest string, affinity double"), ["a", "b", "c"])
    assert sorted(map(tuple, wide.collect())) == [("u", 0.25, 0.5, 0.0), ("v", 0.0, 1.0, 0.0)]
    df = spark.createDataFrame([(dt.date(2024, 1, d), dt.datetime(2024, 1, d, 5)) for d in (1, 20, 31)], "d date, ts timestamp")
    assert incremental.high_water(df, "d", "ts") == dt.datetime(2024, 1, 31, 5) and incremental.high_water(df.where("false"), "d", "ts") is None
