"""The generic tables seen as interval data, for the registered queries.

hits: one row per event, nanosecond intervals [time, endtime), centre, channel, integer area, type and a place on a
20 x n grid. The events are dealt to RUNS runs in turn, so runs overlap in time and a hit_id stands for another hit in each. HITS_SQL
says the same in DuckDB's SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofold.session import table

SECOND = 10**9
DAY = 86_400 * SECOND
RUNS = 3

#: Start and end of the period that the events table covers.
RUN_START, RUN_END = 1_704_067_200 * SECOND, 1_706_745_600 * SECOND

HITS_SQL = """hits AS (
  SELECT hit_id, run_id, time, time + (1 + k) * CAST(1000000000 AS BIGINT) AS endtime,
         time + (1 + k) * CAST(500000000 AS BIGINT) AS center_time, channel, area, type, k, (k % 20) - 10 AS x, (k // 20) - 2 AS y
  FROM (SELECT event_id // 3 AS hit_id, lpad(CAST(event_id % 3 AS VARCHAR), 6, '0') AS run_id, epoch_us(ts) * 1000 AS time, user_id AS channel, CAST(round(value * 100) AS BIGINT) AS area,
               CASE event_type WHEN 'signup' THEN 1 WHEN 'purchase' THEN 2 WHEN 'error' THEN 3 ELSE 0 END AS type,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
        FROM events))"""


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    kind = F.when(F.col("event_type") == "signup", 1).when(F.col("event_type") == "purchase", 2).when(F.col("event_type") == "error", 3).otherwise(0)
    rows = e.select(
        F.expr(f"event_id div {RUNS}").alias("hit_id"), F.lpad((F.col("event_id") % RUNS).cast("string"), 6, "0").alias("run_id"), (F.unix_micros(F.col("ts").cast("timestamp")) * 1000).alias("time"),
        F.col("user_id").alias("channel"), F.round(F.col("value") * 100).cast("long").alias("area"), kind.alias("type"),
        F.get_json_object("props", "$.k").cast("long").alias("k"),
    )
    return rows.withColumns({
        "endtime": F.col("time") + (1 + F.col("k")) * SECOND,
        "center_time": F.col("time") + (1 + F.col("k")) * (SECOND // 2),
        "x": F.col("k") % 20 - 10,
        "y": F.expr("k div 20 - 2"),
    })


def triggers(rows: DataFrame, min_area: int) -> DataFrame:
    return rows.where((F.col("type") == 2) & (F.col("area") > min_area))


def waveforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(wave_id, label, data): embeddings as integer samples."""
    v = table(spark, sf_dir, "embeddings")
    return v.select(F.col("vec_id").alias("wave_id"), "label", F.transform("embedding", lambda x: F.round(x.cast("double") * 1000).cast("long")).alias("data"))


WAVES_SQL = """waves AS (
  SELECT vec_id AS wave_id, label, list_transform(embedding, lambda x: CAST(round(CAST(x AS DOUBLE) * 1000) AS BIGINT)) AS data FROM embeddings)"""


def gains(rows: DataFrame) -> DataFrame:
    """(channel, gain): 1 + channel % 3, zero for dead channels (multiples of 17)."""
    c = rows.select("channel").distinct()
    return c.withColumn("gain", F.when(F.col("channel") % 17 == 0, 0).otherwise(1 + F.col("channel") % 3))
