"""Sessions over a stream: an extension beyond the batch operators, with the same answers on a closed input.

A gap of 30 minutes or more (on whole seconds) ends a session. Spark's session windows keep a gap equal to their
duration together, so the duration is one microsecond less on times cut to seconds. Sessions that span two batches stay
one, late events within the watermark are counted, and state is dropped when the watermark passes a session's end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GAP = "29 minutes 59.999999 seconds"


def stream_sessions(hits: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """device, session_start, session_end, n_events of a stream (or batch) of hits with device and ts."""
    rows = hits.where("device <> ''").select("device", F.date_trunc("second", F.col("ts").cast("timestamp")).alias("ts"))
    rows = rows.withWatermark("ts", lateness) if rows.isStreaming else rows
    found = rows.groupBy("device", F.session_window("ts", GAP).alias("w")).agg(F.min("ts").alias("session_start"), F.max("ts").alias("session_end"), F.count("*").alias("n_events"))
    return found.drop("w")


def run_available(hits: DataFrame, path: str, checkpoint: str) -> None:
    """Process all that has arrived, append the closed sessions to a table, and stop."""
    query = stream_sessions(hits).writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).format("parquet").start(path)
    query.awaitTermination()
