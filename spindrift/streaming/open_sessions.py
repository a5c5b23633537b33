"""Sessions that stay open over batches: hits arrive in batches, some late, and get what one batch of all hits gives.

A hit's ordinal, minutes and first referrer depend on earlier hits of its device alone. So all hits before the watermark
(the newest time seen, less the lateness allowed) are final in a batch, whether their session is still open or not; hits
after it wait for the next batch. Between batches there remain the waiting hits, which cover no more than the
lateness, and one row a device: the time of its last final hit and what the session of that hit began with.

A batch writes ``batch=<n>/`` (hits, state, waiting) and is then published by one entry of a log. A batch that died is
written again from the same inputs; one that was published is not run twice, so a stream can call ``advance`` from
``foreachBatch``.

Defined cases: hits without a time and hits before the watermark of earlier batches are left out and counted (``late``);
an empty batch publishes an empty one; a hit that is delivered twice is two hits.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindrift.operators.sessions import CARRY_FIELDS, order_into_sessions
from spindrift.sources.versions import Log

ENTRY = "watermark timestamp, late long"
STATE = "device string, last_ts timestamp, ordinal long, started timestamp, referrer_first string"


class OpenSessions:
    """Batches below ``path`` of hits with ``schema`` (device, ts, event_id, referrer_host and what else they have).
    ``forget``: devices without a hit for so long lose their state, and their ordinals start again at 0."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, gap_minutes: int = 30, lateness: dt.timedelta = dt.timedelta(hours=1), forget: dt.timedelta | None = None):
        self.spark, self.path, self.schema, self.gap, self.lateness, self.forget = spark, path.rstrip("/"), schema, gap_minutes, lateness, forget
        self.log = Log(spark, f"{self.path}/log", ENTRY)
        if forget is not None and forget < dt.timedelta(minutes=gap_minutes):
            raise ValueError("a device must be remembered for a gap at least")

    def part(self, batch: int, name: str, schema: T.StructType | str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/batch={batch}/{name}")

    def advance(self, hits: DataFrame, batch: int | None = None, last: bool = False) -> int:
        """Take a batch of hits and publish what has become final. ``last``: nothing follows, so all is final."""
        base = self.log.latest()
        batch = (-1 if base is None else base) + 1 if batch is None else batch
        if base is not None and batch <= base:
            return batch
        if batch != (0 if base is None else base + 1):
            raise ValueError(f"batch {batch} does not follow {base}")
        hits = hits.select(*self.schema.fieldNames())
        mark, carry, rows = None, None, hits
        if base is not None:
            mark, carry = self.log.read(base).first()["watermark"], self.part(base, "state", STATE)
        good = F.col("ts").isNotNull() if mark is None else F.coalesce(F.col("ts") >= F.lit(mark), F.lit(False))
        seen = hits.agg(F.max(F.when(good, F.col("ts"))).alias("newest"), F.count_if(~good).alias("late")).first()
        marks = [m for m in (mark, None if seen["newest"] is None else seen["newest"] - self.lateness) if m is not None]
        now = max(marks, default=None)
        rows = hits.where(good)
        if base is not None:
            rows = rows.unionByName(self.part(base, "waiting", self.schema))
        final = F.lit(True) if last else F.lit(False) if now is None else F.col("ts") < F.lit(now)
        folder = f"{self.path}/batch={batch}"
        ordered = order_into_sessions(rows.where(final), self.gap, carry=carry)
        ordered.write.mode("overwrite").parquet(f"{folder}/hits")
        rows.where(~final).write.mode("overwrite").parquet(f"{folder}/waiting")
        done = self.spark.read.schema(ordered.schema).parquet(f"{folder}/hits")
        state = done.groupBy("device").agg(F.max_by(F.struct(F.col("ts").alias("last_ts"), "ordinal", "started", "referrer_first"), F.struct("ts", "event_id")).alias("s")).select("device", "s.*")
        if carry is not None:  # the old state comes before the new one, whose time is never earlier
            both = state.withColumn("age", F.lit(1)).unionByName(carry.withColumn("age", F.lit(0)))
            state = both.groupBy("device").agg(F.max_by(F.struct(*CARRY_FIELDS), "age").alias("s")).select("device", "s.*")
        if self.forget is not None and now is not None:
            state = state.where(F.col("last_ts") >= F.lit(now - self.forget))
        state.write.mode("overwrite").parquet(f"{folder}/state")
        self.log.publish(batch, [(now, seen["late"])])
        return batch

    def read(self) -> DataFrame:
        """All final hits: with ordinal, minutes, started and referrer_first."""
        last = self.log.latest()
        schema = order_into_sessions(self.spark.createDataFrame([], self.schema)).schema
        if last is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/batch={n}/hits" for n in range(last + 1)])

    def late(self) -> int:
        last = self.log.latest()
        return sum(self.log.read(n).first()["late"] for n in range(0 if last is None else last + 1))

    def run_available(self, stream: DataFrame, checkpoint: str) -> None:
        """Take all that has arrived at a stream, in its batches, and stop."""
        begun = self.log.latest()
        query = stream.writeStream.foreachBatch(lambda df, n: self.advance(df, n) and None).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        assert begun is None or self.log.latest() >= begun
