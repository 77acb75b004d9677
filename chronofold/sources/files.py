"""Chunked live files as batch and streaming sources, and generators for tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Fields of a raw record: times in nanoseconds, samples as an array.
RAW_RECORDS = "time long, length int, dt int, channel int, pulse_length int, record_i int, baseline double, data array<int>"


def live_chunks(spark: SparkSession, path: str, schema: str | StructType = RAW_RECORDS, per_trigger: int = 1, fmt: str = "parquet") -> DataFrame:
    """A stream over the chunk folders NNNNNN, NNNNNN_pre and NNNNNN_post below path; adds chunk_i and part."""
    rows = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", per_trigger).option("recursiveFileLookup", "true").load(path)
    return with_chunk(rows)


def read_chunks(spark: SparkSession, path: str, schema: str | StructType = RAW_RECORDS, fmt: str = "parquet") -> DataFrame:
    return with_chunk(spark.read.format(fmt).schema(schema).option("recursiveFileLookup", "true").load(path))


def with_chunk(rows: DataFrame) -> DataFrame:
    name = F.regexp_extract(F.col("_metadata.file_path"), r"/(\d{6})(?:_(pre|post))?/[^/]*$", 1)
    part = F.regexp_extract(F.col("_metadata.file_path"), r"/(\d{6})(?:_(pre|post))?/[^/]*$", 2)
    return rows.select("*", name.cast("int").alias("chunk_i"), F.when(part == "", "central").otherwise(part).alias("part"))


def validate_times(rows: DataFrame, start: int, end: int) -> DataFrame:
    """rows; raises for one that starts outside [start, end)."""
    bad = (F.col("time") < start) | (F.col("time") >= end)
    return rows.withColumn("time", F.when(bad, F.raise_error(F.lit("a record starts outside its chunk")).cast("long")).otherwise(F.col("time")))


def split_overlap(rows: DataFrame, start: int, end: int, min_gap: int, reach: int, channel: int, part: str = "post", width: int | None = None) -> tuple[DataFrame, int]:
    """The overlap region [start, end) of a chunk, cut at a quiet gap: (rows that belong to this side, break time).

    Without rows within min_gap of the end the break is there. Else it is the first gap of min_gap between rows, not before start +
    reach (what rows of the last chunk can extend to). Without such a gap the break is forced min_gap before the end: rows that stick
    out go, and a row of artificial dead time on ``channel`` marks where data may be lost. part: "post" keeps what ends before the
    break, "pre" what starts after it.
    """
    from chronofold.operators import ordered

    last = rows.agg(F.max("endtime")).first()[0]
    if last is None or last + min_gap < end:
        cut, forced = end - min_gap, False
    else:
        runs = ordered.neighbours(rows.withColumn("_one", F.lit(1)), (), ("time",), ("_one",), ("time", "endtime"), width or max(min_gap, 10**9), reach="endtime")
        until = F.greatest(F.coalesce("reach", F.col("endtime")), F.col("endtime"))
        quiet = runs.where((F.col("next_time") - until >= min_gap) & (until >= start + reach)).agg(F.min(until)).first()[0]
        cut, forced = (end - min_gap, True) if quiet is None else (quiet, False)
    kept = rows.where(F.col("endtime") <= cut) if part == "post" else rows.where(F.col("time") >= cut)
    if not forced:
        return kept, cut
    dead = (cut - reach, cut) if part == "post" else (cut, end)
    mark = rows.sparkSession.range(1).select(F.lit(dead[0]).cast("long").alias("time"), F.lit(dead[1]).cast("long").alias("endtime"), F.lit(channel).cast("int").alias("channel"))
    return (kept if part == "post" else kept.limit(0)).unionByName(mark, allowMissingColumns=True), cut


def flip_baseline(rows: DataFrame) -> DataFrame:
    """Old records to new ones: data = baseline - data."""
    return rows.withColumn("data", F.transform("data", lambda x: F.col("baseline") - x))


def remap_channels(df: DataFrame, swap: dict[int, int], channel: str = "channel", array: str | None = None, before: int | None = None) -> DataFrame:
    """Channel numbers, and places in a per-channel array, exchanged by swap; only rows before a time if given."""
    table = F.create_map(*[F.lit(x) for pair in swap.items() for x in pair]) if swap else None
    when = F.lit(True) if before is None else F.col("time") < before
    out = df
    if table is not None and channel in df.columns:
        out = out.withColumn(channel, F.when(when, F.coalesce(F.try_element_at(table, F.col(channel)), F.col(channel))).otherwise(F.col(channel)))
    if table is not None and array:
        back = F.create_map(*[F.lit(x) for a, b in swap.items() for x in (b, a)])
        c = F.col(array)
        moved = F.transform(c, lambda x, i: F.get(c, F.coalesce(F.try_element_at(back, i), i)))
        out = out.withColumn(array, F.when(when, moved).otherwise(c))
    return out


def dummy_records(spark: SparkSession, n: int, channels: int = 10, offset: int = 0, step: int = 1000) -> DataFrame:
    return spark.range(n).select(
        F.lit("000000").alias("run_id"), (F.col("id") * step).alias("time"), (F.col("id") * step + 1).alias("endtime"), F.lit(1).alias("length"), F.lit(1).alias("dt"),
        (F.col("id") % channels + offset).cast("int").alias("channel"),
    )
