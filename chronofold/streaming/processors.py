"""The operators on Structured Streaming.

Nanosecond times get a microsecond copy for watermarks. Tumbling monitors are windowed aggregations; sessions use a
fixed gap; interval joins of two streams carry a time bound so that state is dropped. Scores of the neighbourhood are in release.py.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_timestamp(df: DataFrame, time: str = "time") -> DataFrame:
    return df.withColumn("ts", F.timestamp_micros((F.col(time) / 1000).cast("long")))


def tumbling_monitor(stream: DataFrame, window: str = "1 hour", late: str = "10 minutes", by: str = "type") -> DataFrame:
    """Counts and area sums per window and group; rows later than the watermark are dropped."""
    agg = stream.withWatermark("ts", late).groupBy(F.window("ts", window), F.col(by)).agg(F.count(F.lit(1)).alias("n"), F.sum("area").alias("area"))
    return agg.select(F.unix_micros("window.start").alias("start_us"), by, "n", "area")


def sessions(stream: DataFrame, gap: str, late: str = "10 minutes", by: str = "run_id") -> DataFrame:
    """Sessions of rows at most gap apart, per key."""
    agg = stream.withWatermark("ts", late).groupBy(F.session_window("ts", gap), F.col(by)).agg(F.count(F.lit(1)).alias("n"))
    return agg.select(by, F.unix_micros("session_window.start").alias("start_us"), F.unix_micros("session_window.end").alias("end_us"), "n")


def interval_join(left: DataFrame, right: DataFrame, before: str, late: str = "10 minutes", by: str = "run_id") -> DataFrame:
    """Pairs of a left row and a right row at most ``before`` earlier, of the same key; both sides carry watermarks."""
    a = left.withWatermark("ts", late).alias("a")
    b = right.withWatermark("ts", late).withColumnsRenamed({c: f"r_{c}" for c in right.columns}).alias("b")
    bound = F.expr(f"r_ts <= ts AND r_ts >= ts - INTERVAL {before}")
    return a.join(b, (F.col(by) == F.col(f"r_{by}")) & bound)


def start_available(df: DataFrame, name: str, checkpoint: str, mode: str = "append"):
    """Runs everything that is there into an in-memory table, and ends."""
    return df.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def idempotent_sink(df: DataFrame, path: str, checkpoint: str):
    """Each micro-batch into a folder of its own number: a repeated batch overwrites itself."""
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
