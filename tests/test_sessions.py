"""Sessions of hot devices in slices, and sessions over batches, against one plain pass."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindrift.operators import sessions as S
from spindrift.streaming.open_sessions import OpenSessions

HITS = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("device", T.StringType()), T.StructField("ts", T.TimestampType()), *[T.StructField(c, T.StringType()) for c in ("referrer_host", "url", "note")]])
START = dt.datetime(2024, 1, 1)


def hits(n, seed, bot=0.4):
    """Hits in random order: a bot with a share of all, others with few, repeated times and gaps about the limit."""
    rng = random.Random(seed)
    times = {d: 0.0 for d in ["bot", *"abcdefg"]}
    rows = []
    for i in range(n):
        d = "bot" if rng.random() < bot else rng.choice("abcdefg")
        times[d] += rng.choice([0, 0.2, 1, 30, 600, 1799, 1799.5, 1800, 1801, 5000])
        rows.append((i, d, START + dt.timedelta(seconds=times[d]), rng.choice([None, "r1", "r2"]), "u", "x"))
    rng.shuffle(rows)
    return rows


def plain(rows):
    """event_id -> (ordinal, minutes, started, first referrer)."""
    out, last = {}, {}
    whole = lambda t: int((t - START).total_seconds())
    for i, d, t, ref, *_ in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        seen, ordinal, began, first = last.get(d, (t, 0, t, ref))
        if whole(t) - whole(seen) >= 1800:
            ordinal, began, first = ordinal + 1, t, ref
        last[d] = t, ordinal, began, first
        out[i] = ordinal, (whole(t) - whole(began)) / 60, began, first
    return out


def found(df):
    return {r.event_id: (r.ordinal, pytest.approx(r.minutes), r.started, r.referrer_first) for r in df.collect()}


@pytest.mark.parametrize("hot_rows", [3, 40, None])
def test_slices_equal_one_window(spark, hot_rows):
    rows = hits(600, hot_rows or 0)
    got = S.order_into_sessions(spark.createDataFrame(rows, HITS), hot_rows=hot_rows)
    assert got.columns == [*HITS.fieldNames(), "ordinal", "minutes", "started", "referrer_first"]
    assert found(got) == plain(rows)


def test_a_session_over_many_slices(spark):
    rows = [(i, "bot", START + dt.timedelta(seconds=60 * i), f"r{i}", "u", "x") for i in range(500)] + [(900, "a", START, None, "u", "x")]
    got = S.order_into_sessions(spark.createDataFrame(rows, HITS), hot_rows=10)
    assert found(got) == plain(rows) and got.where("device = 'bot'").select("referrer_first").distinct().collect()[0][0] == "r0"


def test_no_task_holds_the_hot_device(spark):
    """A bot with a third of all hits: its windows' rows are dealt over slices of a quarter of a task's share."""
    other = spark.range(120_000).select(F.col("id").alias("event_id"), (F.col("id") % 5000).cast("string").alias("device"), F.timestamp_seconds(F.col("id") * 7).alias("ts"))
    bot = spark.range(60_000).select((F.col("id") + 1_000_000).alias("event_id"), F.lit("bot").alias("device"), F.timestamp_seconds(F.col("id") * 3).alias("ts"))
    rows = other.unionByName(bot).withColumn("referrer_host", F.lit("r"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = S.order_into_sessions(rows, hot_rows=180_000 // 16)
        sizes = sorted(r[0] for r in got.groupBy(F.spark_partition_id()).count().select("count").collect())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 180_000 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    assert [tuple(r) for r in got.where("device = 'bot'").agg(F.max("ordinal"), F.max("minutes")).collect()] == [(0, pytest.approx(3 * 59_999 / 60))]


def test_edges(spark):
    assert S.order_into_sessions(spark.createDataFrame([], HITS), hot_rows=5).count() == 0
    rows = [(None, "d", START, "r", "u", "x"), (1, None, START, "r", "u", "x"), (2, "d", None, "r", "u", "x")]
    assert S.order_into_sessions(spark.createDataFrame(rows, HITS)).count() == 3


def delivered(rows, k, late=False):
    """Batches by time; with ``late`` some hits come one batch after their time."""
    ordered = sorted(rows, key=lambda r: (r[2], r[0]))
    out = [[] for _ in range(k)]
    for i, r in enumerate(ordered):
        n = i * k // len(ordered)
        soon = ordered[min(len(ordered) - 1, (n + 1) * len(ordered) // k - 1)][2]
        out[min(k - 1, n + 1) if late and r[0] % 5 == 0 and soon - r[2] < dt.timedelta(minutes=50) else n].append(r)
    return out


@pytest.mark.parametrize(("late", "hot_rows"), [(False, 1), (True, None)])
def test_three_batches_equal_one(spark, tmp_path, monkeypatch, late, hot_rows):
    rows = hits(400, 7, bot=0.3)
    if hot_rows:
        monkeypatch.setattr(S, "LEAST_HOT", 5)
    store = OpenSessions(spark, f"{tmp_path}/s", HITS)
    batches = delivered(rows, 3, late)
    for b in batches:
        store.advance(spark.createDataFrame(b, HITS))
    store.advance(spark.createDataFrame([], HITS), last=True)
    assert found(store.read()) == plain(rows) and store.late() == 0
    extra = {c: F.lit("x") for c in S.DEVICE_FIELDS}
    once = S.with_ids(S.order_into_sessions(spark.createDataFrame(rows, HITS)).withColumns(extra))
    ids = lambda df: sorted(map(tuple, df.select("event_id", "session_id").collect()))
    assert ids(S.with_ids(store.read().withColumns(extra))) == ids(once)


def test_late_hits_reruns_and_crashes(spark, tmp_path, monkeypatch):
    hit = lambda i, minutes: (i, "d", START + dt.timedelta(minutes=minutes), f"r{i}", "u", "x")
    store = OpenSessions(spark, f"{tmp_path}/s", HITS)
    one, two = [hit(1, 0), hit(2, 20), hit(3, 200)], [hit(4, 139), hit(5, 150), (6, "d", None, "r", "u", "x")]
    assert store.advance(spark.createDataFrame(one, HITS), 0) == 0
    first = found(store.read())
    assert set(first) == {1, 2}
    assert store.advance(spark.createDataFrame(two, HITS), 0) == 0 and found(store.read()) == first  # batch 0 is done
    with pytest.raises(ValueError):
        store.advance(spark.createDataFrame(two, HITS), 5)
    with monkeypatch.context() as m:
        m.setattr(type(store.log), "publish", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.advance(spark.createDataFrame(two, HITS), 1)
    assert found(store.read()) == first
    store.advance(spark.createDataFrame(two, HITS), 1)
    store.advance(spark.createDataFrame([], HITS), last=True)
    kept = [r for r in one + two if r[0] in (1, 2, 3, 5)]
    assert found(store.read()) == plain(kept) and store.late() == 2  # before the watermark, and without a time


def test_devices_are_forgotten(spark, tmp_path):
    hit = lambda i, d, hours: (i, d, START + dt.timedelta(hours=hours), "r", "u", "x")
    store = OpenSessions(spark, f"{tmp_path}/s", HITS, forget=dt.timedelta(hours=10))
    for b in ([hit(1, "a", 0), hit(2, "b", 0)], [hit(3, "b", 20)], [hit(4, "a", 30), hit(5, "b", 30)]):
        store.advance(spark.createDataFrame(b, HITS))
    store.advance(spark.createDataFrame([], HITS), last=True)
    assert {k: v[0] for k, v in found(store.read()).items()} == {1: 0, 2: 0, 3: 0, 4: 0, 5: 1}  # only b was seen within ten hours before it came again
    with pytest.raises(ValueError):
        OpenSessions(spark, "x", HITS, forget=dt.timedelta(minutes=1))


def test_a_stream_feeds_the_batches(spark, tmp_path):
    rows = hits(150, 3)
    for k, b in enumerate(delivered(rows, 3)):
        spark.createDataFrame(b, HITS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(HITS).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    store = OpenSessions(spark, f"{tmp_path}/s", HITS, lateness=dt.timedelta(days=2))
    store.run_available(stream, f"{tmp_path}/c")
    store.run_available(stream, f"{tmp_path}/c")
    store.advance(spark.createDataFrame([], HITS), last=True)
    assert found(store.read()) == plain(rows)


def test_pages_and_agents_are_read_once_each(spark):
    """The columns are those of a reading of each hit, but no hit's URL or agent is read by patterns."""
    from spindrift.functions import device, urls
    from spindrift.sources import fixtures as X

    folder = "/root/testdata/sf0.001"
    h = X.hits(spark, folder).where("device <> ''")
    each = h.select("*", urls.normalise("url").alias("url_normalized"), device.search_engine("referrer_host", "url").alias("search_engine"), *device.parse("user_agent"))
    found = X.enriched(spark, folder)
    assert found.columns == each.columns and found.count() == each.count() and found.exceptAll(each).count() == 0
    above = found._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    assert "regexp" not in above
