"""Slow-control series and clock synchronisation: time series joined and filled by time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofold.operators import ordered
from chronofold.operators.intervals import RUN, nearest
from chronofold.operators.ordered import match


def calendar(df: DataFrame, start: int, end: int, step: int, by: Sequence[str] = RUN) -> DataFrame:
    """One row per step in [start, end] for each series; the sequence is exploded where its chunk of steps is made."""
    chunk = 100_000
    series = df.select(*by).distinct()
    parts = series.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit((end - start) // step // chunk).cast("long"))))
    steps = F.sequence(F.col("_part") * chunk, F.least((F.col("_part") + 1) * chunk - 1, F.lit((end - start) // step).cast("long")))
    return parts.withColumn("_i", F.explode(steps)).select(*by, (F.lit(start) + F.col("_i") * step).alias("time"))


def fill(df: DataFrame, start: int, end: int, step: int, how: str = "ffill", value: str = "value", by: Sequence[str] = RUN, width: int = ordered.HOUR) -> DataFrame:
    """value on the calendar: none (only exact times), ffill, or interpolate (linear between neighbours; null beyond the ends)."""
    days = calendar(df, start, end, step, by).withColumn("_cal", F.lit(True))
    both = days.unionByName(df.select(*by, "time", F.col(value).cast("double").alias("_x"), F.lit(False).alias("_cal")), allowMissingColumns=True)
    if how == "none":
        at = df.select(*by, "time", F.col(value).cast("double").alias(value))
        return match(days.drop("_cal"), at, [*by, "time"], "left")
    both = both.withColumn("_side", F.col("_cal").cast("int"))
    if how == "ffill":
        out = ordered.fill_forward(both, "_x", value, by, ("time", "_side"), width)
        return out.where("_cal").select(*by, "time", value)
    if how != "interpolate":
        raise ValueError(f"unknown filling {how!r}")
    point = F.when(~F.col("_cal"), F.struct("time", F.col("_x").alias("v")))
    both = both.withColumn("_p", point)
    both = ordered.fill_forward(both, "_p", "_a", by, ("time", "_side"), width)
    both = ordered.fill_backward(both.withColumn("_side", -F.col("_side")), "_p", "_b", by, ("time", "_side"), width)
    t, a, b = F.col("time"), F.col("_a"), F.col("_b")
    line = F.when(a["time"] == b["time"], a["v"]).otherwise(a["v"] + (b["v"] - a["v"]) * ((t - a["time"]) / (b["time"] - a["time"])))
    return both.where("_cal").select(*by, "time", line.alias(value))


def average_every(df: DataFrame, n: int, value: str = "value", by: Sequence[str] = RUN, order: Sequence[str] = ("time",), width: int = ordered.HOUR) -> DataFrame:
    """Means of every n values in time order; the incomplete tail goes, and one more bin if n does not divide the length."""
    rows = ordered.row_numbers(df, "_i", by, order, width).withColumn("bin", F.expr(f"_i div {n}"))
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    bins = F.expr(f"_n div {n} - if(_n % {n} = 0, 0, 1)")
    means = rows.groupBy(*by, "bin").agg(F.min("time").alias("time"), F.avg(value).alias(value))
    return match(means, sizes, by).where(F.col("bin") < bins).drop("_n")


def interpolate_clock(
    pulses: DataFrame, syncs: DataFrame, key: str, truth: str = "truth", by: Sequence[str] = RUN, width: int = ordered.HOUR, extrapolate: bool = True, delay: int = 0
) -> DataFrame:
    """(by, key, synced): the truth clock at each pulse less ``delay``, linear between the sync before (or at) and the next.

    Before the first and after the last sync of a run, the line of its two nearest syncs goes on; without extrapolate,
    and in a run with a single sync time, it is null there.
    """
    points = syncs.select(*by, "time", truth, F.col("time").alias("_id"))
    cols = [truth]
    if extrapolate:
        points = points.groupBy(*by, "time").agg(F.max(truth).alias(truth)).withColumn("_id", F.col("time"))
        points = ordered.neighbours(points, ["time", truth], ["time", truth], by, ("time",), width)
        cols = [truth, "prev_time", f"prev_{truth}", "next_time", f"next_{truth}"]
    lean = pulses.select(*by, "time", key)
    at = lambda side: [F.col("n_time").alias(f"t{side}"), *[F.col(f"n_{c}").alias(f"{c}{side}") for c in cols]]
    prev = nearest(lean, points, cols, None, "before", False, by, key, "_id", width).select(*by, key, "time", *at(0))
    nxt = nearest(lean, points, cols, None, "after", False, by, key, "_id", width).select(*by, key, *at(1))
    both = match(prev, nxt, [*by, key])
    t0, g0, t1, g1 = (F.col(c) for c in ("t0", f"{truth}0", "t1", f"{truth}1"))
    if extrapolate:
        # After the last sync: from the one before it through the last. Before the first: from the first through its next.
        late, early = t1.isNull(), t0.isNull()
        t0, g0, t1, g1 = (
            F.when(late, F.col("prev_time0")).when(early, t1).otherwise(t0), F.when(late, F.col(f"prev_{truth}0")).when(early, g1).otherwise(g0),
            F.when(late, t0).when(early, F.col("next_time1")).otherwise(t1), F.when(late, g0).when(early, F.col(f"next_{truth}1")).otherwise(g1),
        )
    frac = F.try_divide((F.col("time") - t0).cast("double"), (t1 - t0).cast("double"))
    line = g0 + F.when(t0 == t1, F.lit(0)).otherwise((frac * (g1 - g0)).cast("long"))
    return both.select(*by, key, (line - delay).alias("synced"))


def every_nth(df: DataFrame, n: int, by: Sequence[str] = RUN, order: Sequence[str] = ("time",), width: int = ordered.HOUR) -> DataFrame:
    return ordered.row_numbers(df, "_i", by, order, width).where(F.col("_i") % n == 0).drop("_i")
