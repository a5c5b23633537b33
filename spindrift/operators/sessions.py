"""Hits to sessions, page views and dimensions.

A device's hits are numbered within windows of the device. A device with so many hits that its window would outgrow the
other tasks is cut into slices of time: each slice is numbered by itself, and the slices' boundary rows (first and last
second, splits, the session open at the end) give by a prefix sum what each slice has to add. Only these devices'
boundary rows, one a slice, are gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEVICE_FIELDS = ["device_category", "device_brand_name", "device_marketing_name", "os_name", "os_version", "browser_name"]
#: State of a device between batches: the last hit's time and what its session began with.
CARRY_FIELDS = ["last_ts", "ordinal", "started", "referrer_first"]
#: Hits of a device that are never worth a slice of their own, and the most slices of a device.
LEAST_HOT, SLICES = 100_000, 256


def key_hash(*columns: str) -> Column:
    """64-bit id of several columns; a NULL is told from a shift of the others."""
    return F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\u0001")) for c in columns])


def time_cuts(hits: DataFrame, device: str, ts: str, hot_rows: int | None) -> DataFrame | None:
    """(device, _cuts: ascending seconds) of the devices with more than ``hot_rows`` hits, or None without such. By
    default these have over a quarter of a task's even share of all hits, so there are fewer than four a task: their
    cuts can be sent to all tasks."""
    counts = hits.groupBy(F.col(device).alias("_d")).agg(F.count("*").alias("_n"))
    total, most = counts.agg(F.sum("_n"), F.max("_n")).first()
    tasks = int(hits.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot_rows = hot_rows or max(LEAST_HOT, (total or 0) // (4 * tasks))
    if (most or 0) <= hot_rows:
        return None
    hot = counts.where(F.col("_n") > hot_rows)
    rows = hits.select(F.col(device).alias("_d"), F.unix_timestamp(ts).alias("_s")).join(F.broadcast(hot), "_d")
    shares = [i / SLICES for i in range(1, SLICES)]
    quantiles = rows.groupBy("_d").agg(F.percentile_approx("_s", shares, 4 * SLICES).alias("_q"), F.max("_n").alias("_n"))
    step = F.greatest(F.lit(1), F.floor(F.lit(SLICES * hot_rows) / F.col("_n")).cast("int"))
    return quantiles.select("_d", F.array_distinct(F.filter("_q", lambda q, i: (i + 1) % step == 0)).alias("_cuts"))


def order_into_sessions(hits: DataFrame, gap_minutes: int = 30, device: str = "device", ts: str = "ts", tie: str = "event_id", carry: DataFrame | None = None, hot_rows: int | None = None) -> DataFrame:
    """Adds ``ordinal`` (0, 1, ... of the device; a gap of ``gap_minutes`` or more starts the next), ``minutes`` (since
    the ordinal's first hit, in whole seconds), ``started`` (that hit's time) and ``referrer_first``. One shuffle of the
    hits, on the device (and slice).

    ``carry``: the devices' state after earlier hits (device, CARRY_FIELDS), all of them before these; sessions go on.
    ``hot_rows``: hits from which a device is sliced. Hits of one second stay together."""
    rows = hits.withColumns({"_base": F.lit(None).cast("long"), "_state": F.lit(False), "_open": F.struct(F.col(ts).alias("started"), F.col("referrer_host").alias("referrer_first"))})
    if carry is not None:
        open_ = F.struct("started", "referrer_first").alias("_open")
        rows = rows.unionByName(carry.select(F.col("device").alias(device), F.col("last_ts").alias(ts), F.col("ordinal").alias("_base"), F.lit(True).alias("_state"), open_), allowMissingColumns=True)
    cuts = time_cuts(hits, device, ts, hot_rows)
    key = [device]
    if cuts is not None:
        rows = rows.join(F.broadcast(cuts), F.col(device) == F.col("_d"), "left").withColumn("_slice", F.coalesce(F.size(F.filter("_cuts", lambda c: c < F.unix_timestamp(ts))), F.lit(0))).drop("_cuts")
        key = [device, "_slice"]
    gap = F.lit(60 * gap_minutes)

    def numbered(rows: DataFrame) -> DataFrame:
        """``_o`` from 0 within the key, and the session's beginning there. A carried state comes first."""
        order = [F.asc(ts), F.desc("_state"), F.asc(tie)]
        by = Window.partitionBy(*key).orderBy(*order)
        seconds = F.unix_timestamp(ts)
        split = F.coalesce((seconds - F.lag(seconds).over(by) >= gap).cast("long"), F.lit(0))
        rows = rows.withColumn("_split", split).withColumn("_o", F.sum("_split").over(by.rowsBetween(Window.unboundedPreceding, 0)))
        return rows.withColumns({"_open": F.first("_open").over(Window.partitionBy(*key, "_o").orderBy(*order)), "_base": F.first("_base").over(by)})

    out = numbered(rows)
    ordinal, opened = F.coalesce("_base", F.lit(0)) + F.col("_o"), F.col("_open")
    if cuts is not None:
        slim = rows.where(F.col("_d").isNotNull()).select(*key, ts, tie, "_base", "_state", "_open")
        stitch = stitched(numbered(slim), device, ts, gap)
        out = out.join(F.broadcast(stitch), [device, "_slice"], "left")
        ordinal = F.coalesce(F.col("_add") + F.col("_o"), ordinal)
        opened = F.when((F.col("_o") == 0) & F.col("_goes_on"), F.col("_carried")).otherwise(opened)
    out = out.withColumns({"ordinal": ordinal, "_open": opened})
    if carry is not None:
        out = out.where(~F.col("_state"))
    out = out.withColumns({"minutes": (F.unix_timestamp(ts) - F.unix_timestamp("_open.started")) / 60.0, "started": F.col("_open.started"), "referrer_first": F.col("_open.referrer_first")})
    return out.select(*hits.columns, "ordinal", "minutes", "started", "referrer_first")


def stitched(numbered: DataFrame, device: str, ts: str, gap: Column) -> DataFrame:
    """(device, _slice, _add, _goes_on, _carried): what a slice's numbers lack, whether its first session began in an
    earlier slice, and with what. A device has no more than SLICES boundary rows."""
    seconds = F.unix_timestamp(ts)
    ends = numbered.groupBy(device, "_slice").agg(
        F.min(seconds).alias("lo"), F.max(seconds).alias("hi"), F.max("_o").alias("m"), F.max("_base").alias("base"), F.max_by("_open", "_o").alias("last_open")
    )
    w = Window.partitionBy(device).orderBy("_slice")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("_goes_on", F.coalesce(F.col("lo") - F.lag("hi").over(w) < gap, F.lit(False)))
    starts = F.when(F.lag("hi").over(w).isNull() | F.col("_goes_on"), F.lit(0)).otherwise(1)
    ends = ends.withColumns({"starts": starts, "begun": F.when((F.col("m") > 0) | ~F.col("_goes_on"), F.col("last_open"))})
    add = F.coalesce(F.max("base").over(w), F.lit(0)) + F.coalesce(F.sum("m").over(before), F.lit(0)) + F.sum("starts").over(w)
    return ends.select(device, "_slice", add.alias("_add"), "_goes_on", F.last("begun", ignorenulls=True).over(before).alias("_carried"))


def with_ids(ordered: DataFrame, compat_ids: bool = False) -> DataFrame:
    """Ordered hits with the ``session_id`` of their device, ordinal, device fields and beginning (``compat_ids`` leaves
    the beginning out: ids then repeat over batches)."""
    keys = ["device", "ordinal", *DEVICE_FIELDS]
    return ordered.withColumn("session_id", key_hash(*keys, *([] if compat_ids else ["started"])))


def roll_up(ordered: DataFrame, compat_ids: bool = False) -> DataFrame:
    """One row per device, ordinal and device fields. Aggregated before the shuffle; no hits are gathered."""
    keys = ["device", "ordinal", *DEVICE_FIELDS, "session_id"]
    rolled = with_ids(ordered, compat_ids).groupBy(*keys).agg(
        F.max("minutes").alias("total_minutes"), F.min("ts").alias("session_start"), F.max("ts").alias("session_end"), F.count("*").alias("n_events"),
        F.count_distinct("url").alias("unique_page_views"), F.min_by("referrer_first", F.struct("ts", "event_id")).alias("referrer_first"),
    )
    return rolled.withColumns({"session_date": F.to_date("session_start"), **dimension_ids()})


def dimension_ids() -> dict[str, Column]:
    return {"device_id": key_hash(*DEVICE_FIELDS[:3]), "browser_id": key_hash("browser_name"), "os_id": key_hash("os_name", "os_version")}


def dimensions(sessions: DataFrame) -> dict[str, DataFrame]:
    """The small tables of devices, browsers and systems."""
    return {
        "device": sessions.select("device_id", *DEVICE_FIELDS[:3]).distinct(),
        "browser": sessions.select("browser_id", "browser_name").distinct(),
        "os": sessions.select("os_id", "os_name", "os_version").distinct(),
    }


def join_dimensions(sessions: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Sessions without their device fields, joined with the three dimensions. Spark broadcasts a dimension if its
    measured size allows it."""
    out = sessions.drop(*DEVICE_FIELDS)
    for name, dim in dims.items():
        out = out.join(dim, f"{name}_id", "left")
    return out


def page_views(ordered: DataFrame, compat_ids: bool = False) -> DataFrame:
    """The ordered hits with a URL, each with its session's id and an id of its own that a rerun repeats. No shuffle."""
    fields = ["session_id", "device", "ordinal", "ts", "event_id", "url", "url_normalized", "owner_name", "search_engine"]
    rows = with_ids(ordered, compat_ids).where("url <> ''").select(*fields)
    view_id = F.sha2(F.concat_ws("|", F.col("session_id").cast("string"), F.unix_micros(F.col("ts").cast("timestamp")).cast("string"), "url", F.col("event_id").cast("string")), 256)
    return rows.withColumns({"page_view_id": view_id, "view_date": F.to_date("ts")})
