"""Scores of the neighbourhood on a stream whose rows come late and in any order.

A stateful operator holds rows per key and time bucket until the watermark says that the bucket is whole, then releases
them in order, together with copies of the rows of other buckets that its own rows can see. Released buckets are complete, so the
operators of the batch engine run on them as they are, in foreachBatch, with the bucket as part of the run key.

State is bounded by the watermark's delay: what a bucket holds goes when its event-time timer fires. Keys are (run, bucket), so no run is
one task. Rows behind the watermark do not enter the state; they come out at once, marked late, and become dead time.
Needs a state store with event-time timers: see release_config().
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import BooleanType, StructField, StructType

from chronofold.operators.intervals import RUN
from chronofold.operators.ordered import match


def release_config(spark: SparkSession) -> None:
    """The state store that timers and lists need."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class _Hold(StatefulProcessor):
    def __init__(self, schema: StructType, by: int, width: int, ahead: int):
        self.schema, self.by, self.width, self.ahead = schema, by, width, ahead

    def init(self, handle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", self.schema)

    def _end(self, bucket: int) -> int:
        """When, in milliseconds, nothing can come any more that the bucket's rows see."""
        return -(-((bucket + 1) * self.width + self.ahead) // 10**6)

    def _out(self, rows: pd.DataFrame, late: bool) -> pd.DataFrame:
        return rows.assign(late=late)[[*self.schema.names, "late"]]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        reached, held = timerValues.getCurrentWatermarkInMs(), False
        for frame in rows:
            behind = frame["time"] // 10**6 < reached
            if behind.any():
                yield self._out(frame[behind & frame["own"]], True)
            fresh = frame.loc[~behind, self.schema.names]
            if len(fresh):
                held = True
                plain = fresh.astype(object).where(fresh.notna(), None)
                self.rows.appendList(list(plain.itertuples(index=False, name=None)))
        if held:
            self.handle.registerTimer(self._end(int(key[self.by])))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        found = pd.DataFrame(list(self.rows.get()), columns=self.schema.names)
        self.rows.clear()
        yield self._out(found.sort_values("time", kind="stable"), False)

    def close(self) -> None:
        pass


def release(stream: DataFrame, width: int, back: int, ahead: int = 0, late: str = "10 seconds", center: str = "center_time", by: Sequence[str] = RUN) -> DataFrame:
    """stream's columns with ``bucket``, ``own`` and ``late``.

    Buckets of ``width`` ns, by centre. A bucket is released, in time order, when the watermark (``late`` behind the latest time) has passed all that its
    rows can see: ``back`` before and ``ahead`` after their centres. Rows of other buckets that reach into that are there too, with own = false.
    A row behind the watermark comes out once, at once, with late = true.
    """
    floor = lambda c: F.call_function("div", c - F.pmod(c, F.lit(width)), F.lit(width))
    first = F.least(floor(F.col("time") - ahead), floor(F.col(center)))
    last = F.greatest(floor(F.col("endtime") + back), floor(F.col(center)))
    rows = stream.withColumn("bucket", F.explode(F.sequence(first, last))).withColumn("own", F.col("bucket") == floor(F.col(center)))
    schema = StructType([f for f in rows.schema.fields])
    out = StructType([*schema.fields, StructField("late", BooleanType())])
    timed = rows.withColumn("_ts", F.timestamp_micros(F.call_function("div", F.col("time"), F.lit(1000)))).withWatermark("_ts", late)
    # Without its mark the watermark still drives the timers, but rows behind it are not dropped before the operator sees them.
    timed = timed.withColumn("_seen", F.timestamp_micros(F.unix_micros("_ts"))).drop("_ts")
    return timed.groupBy(*by, "bucket").transformWithStateInPandas(_Hold(schema, len(by), width, ahead), out, "Append", "EventTime")


def score_released(released: DataFrame, score: Callable[[DataFrame, Sequence[str]], DataFrame], path: str, checkpoint: str, key: str = "hit_id", by: Sequence[str] = RUN):
    """Starts the query: score(rows, run key) of each released bucket, for its own rows, into path/scores, late rows into path/late.

    A micro-batch goes to folders of its own number, so one that is repeated overwrites itself.
    """
    run = [*by, "bucket"]

    def write(batch: DataFrame, number: int) -> None:
        held = batch.persist()
        rows = held.where("not late").drop("late")
        own = rows.where("own").select(*run, key)
        match(score(rows, run), own, [*run, key], "left_semi").drop("bucket").write.mode("overwrite").parquet(f"{path}/scores/batch={number}")
        held.where("late").drop("late", "own", "bucket").write.mode("overwrite").parquet(f"{path}/late/batch={number}")
        held.unpersist()

    return released.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def dead_spans(late: DataFrame, channel: int, by: str = "run_id") -> DataFrame:
    """The time that each late row covers, as artificial dead time on a channel."""
    return late.select(by, "time", "endtime", F.lit(channel).alias("channel"))
