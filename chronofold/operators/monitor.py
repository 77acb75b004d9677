"""Monitoring aggregates: histograms, rates, pulse counts, samples. All combine on the map side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronofold.operators import ordered
from chronofold.operators.intervals import RUN


def bin_of(x: Column, lo: float, hi: float, n: int) -> Column:
    """0-based bin of n equal ones over [lo, hi], the last closed on the right; null outside."""
    at = F.floor((x.cast("double") - lo) / (hi - lo) * n)
    return F.when((x >= lo) & (x <= hi), F.least(at, F.lit(n - 1))).cast("long")


def half_open_bin(x: Column, lo: float, hi: float, n: int) -> Column:
    """As bin_of with every bin open on the right; -1 outside."""
    return F.when((x >= lo) & (x < hi), F.floor((x.cast("double") - lo) / (hi - lo) * n)).otherwise(-1).cast("long")


def histogram(df: DataFrame, x: Column, lo: float, hi: float, n: int, by: Sequence[str] = (), weight: Column | None = None) -> DataFrame:
    """(by, bin, count): only bins with rows."""
    binned = df.select(*by, bin_of(x, lo, hi, n).alias("bin"), (weight if weight is not None else F.lit(1)).alias("w")).where("bin is not null")
    return binned.groupBy(*by, "bin").agg(F.sum("w").alias("count"))


def histogram2d(df: DataFrame, x: Column, y: Column, xr: tuple, yr: tuple, by: Sequence[str] = ()) -> DataFrame:
    """(by, bin_x, bin_y, count); ranges are (lo, hi, n)."""
    binned = df.select(*by, bin_of(x, *xr).alias("bin_x"), bin_of(y, *yr).alias("bin_y")).where("bin_x is not null and bin_y is not null")
    return binned.groupBy(*by, "bin_x", "bin_y").agg(F.count(F.lit(1)).alias("count"))


def profile(df: DataFrame, x: Column, y: Column, value: Column, xr: tuple, yr: tuple) -> DataFrame:
    """(bin_x, bin_y, count, mean): a third axis projected to its mean."""
    binned = df.select(bin_of(x, *xr).alias("bin_x"), bin_of(y, *yr).alias("bin_y"), value.alias("v")).where("bin_x is not null and bin_y is not null")
    return binned.groupBy("bin_x", "bin_y").agg(F.count(F.lit(1)).alias("count"), F.avg("v").alias("mean"))


def modal_centre(df: DataFrame, x: Column, lo: float, hi: float, n: int, by: Sequence[str] = ()) -> DataFrame:
    """(by, mode): centre of the fullest bin, the first on ties."""
    h = histogram(df, x, lo, hi, n, by)
    top = F.max_by("bin", F.struct("count", -F.col("bin")))
    return h.groupBy(*by).agg((F.lit(lo) + (top + 0.5) * F.lit((hi - lo) / n)).alias("mode"))


def per_chunk(df: DataFrame, chunk: int, time: str = "time") -> DataFrame:
    """Adds ``chunk``: the number of the tumbling window that holds the row."""
    return df.withColumn("chunk", F.expr(f"({time} - pmod({time}, {chunk}L)) div {chunk}L"))


def pulse_counts(df: DataFrame, by: Sequence[str] = ("run_id", "channel"), key: str = "hit_id", width: int = ordered.HOUR) -> DataFrame:
    """Per channel: pulses, area, lone pulses (start after all before have ended, end before the next starts; the last is never lone)
    and the mean area, cut to an integer."""
    rows = ordered.neighbours(df, (), ["time"], by, ("time", key), width, reach="endtime")
    lone = (F.col("reach").isNull() | (F.col("time") >= F.col("reach"))) & F.coalesce(F.col("endtime") < F.col("next_time"), F.lit(False))
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("pulse_count"), F.sum("area").alias("pulse_area"), F.count_if(lone).alias("lone_pulse_count"),
        F.coalesce(F.sum(F.when(lone, F.col("area"))), F.lit(0).cast("long")).alias("lone_pulse_area"),
        F.expr("cast(avg(area) as bigint)").alias("mean_area"),
    )


def channel_dimension(df: DataFrame, nominal: DataFrame, channel: str = "channel") -> DataFrame:
    """The nominal channels and every other channel that df has; rows without a channel name none."""
    return nominal.select(channel).union(df.select(channel).where(F.col(channel).isNotNull())).distinct()


def dark_rate(df: DataFrame, channels: DataFrame, seconds: float, value: str = "area", channel: str = "channel") -> DataFrame:
    """Per channel of the dimension: n / T, sqrt(n) / T, mean and population deviation; a silent channel has rate 0 and no mean."""
    found = df.groupBy(channel).agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("deviation"))
    n = F.coalesce("n", F.lit(0))
    return channels.join(found, channel, "left").select(
        channel, (n / F.lit(seconds)).alias("dark_rate"), (F.sqrt(n) / F.lit(seconds)).alias("dark_rate_error"), "mean", "deviation"
    )


def veto_event_properties(hitlets: DataFrame, event: str = "event_number", time: str = "time", area: str = "area", by: Sequence[str] = RUN, key: str = "hit_id") -> DataFrame:
    """Per event: area, hits, channels, area-weighted centre and spread of time from the first hit, least and largest gap."""
    w = Window.partitionBy(*by, event)
    rows = hitlets.withColumn("_t0", F.min(time).over(w))
    rows = rows.withColumn("_gap", F.col(time) - F.lag(time).over(w.orderBy(time, key)))
    t, a = (F.col(time) - F.col("_t0")).cast("double"), F.col(area).cast("double")
    # The mean first, then the squares around it: nothing cancels.
    rows = rows.withColumn("_mean", F.try_divide(F.sum(a * t).over(w), F.sum(a).over(w)))
    off = t - F.col("_mean")
    var = F.try_divide(F.sum(a * off * off), F.sum(a))
    return rows.groupBy(*by, event).agg(
        F.sum(area).alias("area"), F.count(F.lit(1)).alias("n_hits"), F.countDistinct("channel").alias("n_channels"), F.first("_mean").alias("center_time"),
        F.sqrt(F.greatest(var, F.lit(0.0))).alias("center_time_spread"), F.min("_gap").alias("min_gap"), F.max("_gap").alias("max_gap"),
    )


def area_per_channel(hitlets: DataFrame, n_channels: int, event: str = "event_number", area: str = "area", channel: str = "channel", by: Sequence[str] = RUN) -> DataFrame:
    """(by, event, area_per_channel): an array of n_channels sums for each event; channels beyond it are left out."""
    sums = hitlets.where(F.col(channel).between(0, n_channels - 1)).groupBy(*by, event, channel).agg(F.sum(area).alias("a"))
    found = sums.groupBy(*by, event).agg(F.map_from_entries(F.collect_list(F.struct(F.col(channel).cast("int").alias("c"), "a"))).alias("m"))
    zero = F.lit(0).cast(sums.schema["a"].dataType)
    return found.select(*by, event, F.transform(F.sequence(F.lit(0), F.lit(n_channels - 1)), lambda c: F.coalesce(F.try_element_at("m", c), zero)).alias("area_per_channel"))


def veto_event_position(
    hitlets: DataFrame, event: str = "event_number", area: str = "area", prompt: int | None = None, time: str = "time", by: Sequence[str] = RUN, axes: Sequence[str] = ("x", "y")
) -> DataFrame:
    """Area-weighted place and spread of each event along the axes, from the hits less than ``prompt`` after its first one (all if not
    given), its hits, and its azimuth in [0, 2 pi); no azimuth at the origin."""
    a = F.col(area).cast("double")
    rows = hitlets
    if prompt is not None:
        rows = hitlets.withColumn("_t0", F.min(time).over(Window.partitionBy(*by, event))).where(F.col(time) - F.col("_t0") < prompt)
    aggs, w = [F.count(F.lit(1)).alias("n_prompt_hits")], Window.partitionBy(*by, event)
    for c in axes:
        rows = rows.withColumn(f"_mean_{c}", F.try_divide(F.sum(a * F.col(c)).over(w), F.sum(a).over(w)))
        off = F.col(c) - F.col(f"_mean_{c}")
        var = F.try_divide(F.sum(a * off * off), F.sum(a))
        aggs += [F.first(f"_mean_{c}").alias(f"pos_{c}"), F.sqrt(F.greatest(var, F.lit(0.0))).alias(f"pos_{c}_spread")]
    return rows.groupBy(*by, event).agg(*aggs).withColumn("angle", azimuth(F.col("pos_x"), F.col("pos_y")))


def azimuth(x: Column, y: Column) -> Column:
    return F.when((x != 0) | (y != 0), F.pmod(F.atan2(y, x), F.lit(2) * F.pi()))


def online_veto_counts(events: DataFrame, thresholds: Sequence[int] = (4, 5, 8, 10), channels: str = "n_channels", by: Sequence[str] = ()) -> DataFrame:
    return events.groupBy(*by).agg(*[F.count_if(F.col(channels) >= n).alias(f"events_{n}coinc") for n in thresholds])


def sample_to_budget(df: DataFrame, row_bytes: int, budget: int, key: str, total: int) -> DataFrame:
    """About budget bytes of rows, picked by the key's hash without a sort, with weight = all / expected kept."""
    share = min(1.0, budget / max(row_bytes * total, 1))
    cut = F.lit(int(share * 2**32))
    return df.where(F.pmod(F.xxhash64(key), F.lit(2**32)) < cut).withColumn("weight", F.lit(1.0 / share if share else 0.0))
