"""Small projections, selections and lookups: column helpers, run and channel selections, spectra, identifiers, times."""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from chronofold.operators.intervals import RUN, overlap_join
from chronofold.operators.ordered import HOUR, match

#: Tables that hold each other's columns; a query loads one of them at most (fixed names of the data model).
EXCLUSIVE = ("event_positions", "corrected_areas", "energy_estimates")


def pass_through(df: DataFrame, fields: Sequence[str], by: Sequence[str] = RUN) -> DataFrame:
    return df.select(*by, "time", "endtime", *fields)


def with_default_position(df: DataFrame, algorithm: str) -> DataFrame:
    """x and y as those of one algorithm, whose own columns stay."""
    return df.withColumns({"x": F.col(f"x_{algorithm}"), "y": F.col(f"y_{algorithm}")})


def without_arrays(df: DataFrame) -> DataFrame:
    return df.select(*[f.name for f in df.schema.fields if not isinstance(f.dataType, ArrayType)])


def check_exclusive(targets: Sequence[str], exclusive: Sequence[str] = EXCLUSIVE) -> None:
    both = sorted(set(targets) & set(exclusive))
    if len(both) > 1:
        raise ValueError(f"load one of {', '.join(both)} at most")


def apply_function(df: DataFrame, function: Callable[[DataFrame, str, Sequence[str]], DataFrame], run: str, targets: Sequence[str]) -> DataFrame:
    """The user's hook on load; it gets and returns a DataFrame."""
    return df.transform(lambda d: function(d, run, targets))


def time_within(df: DataFrame, intervals: DataFrame, key: str = "hit_id", by: Sequence[str] = RUN, width: int = HOUR) -> DataFrame:
    """Rows fully inside one of the intervals."""
    held = overlap_join(df.select(*by, "time", "endtime", key), intervals.select(*by, "time", "endtime"), by, width, "contained")
    return match(df, held.select(*by, key).distinct(), [*by, key], "left_semi")


def single_electrons(df: DataFrame, area: tuple = (10, 80), width: tuple = (80, 700)) -> DataFrame:
    """Type 2, area and width between limits (exclusive), an area fraction top other than 0."""
    inside = lambda c, lim: (F.col(c) > lim[0]) & (F.col(c) < lim[1])
    return df.where((F.col("type") == 2) & inside("area", area) & inside("range_50p", width) & (F.col("area_fraction_top") != 0))


def assert_channels(df: DataFrame, allowed: Sequence[int], channel: str = "channel") -> DataFrame:
    bad = F.raise_error(F.concat(F.lit("channel not allowed here: "), F.col(channel).cast("string"))).cast(df.schema[channel].dataType)
    return df.withColumn(channel, F.when(F.col(channel).isin(*allowed), F.col(channel)).otherwise(bad))


def channel_thresholds(spark, groups: Sequence[tuple[int, Sequence[int]]]) -> DataFrame:
    """(channel, threshold) of (threshold, channels) groups; a channel in two groups raises."""
    rows = [(c, t) for t, channels in groups for c in channels]
    if len({c for c, _ in rows}) < len(rows):
        raise ValueError("a channel has two thresholds")
    return spark.createDataFrame(rows, "channel long, threshold long")


def over_threshold(df: DataFrame, thresholds: DataFrame, value: str = "area", channel: str = "channel") -> DataFrame:
    """Rows at or above their channel's threshold; channels without one are left out. Spark broadcasts the thresholds only if they are small."""
    return df.join(thresholds, channel).where(F.col(value) >= F.col("threshold")).drop("threshold")


def partition(df: DataFrame, mask: Column) -> tuple[DataFrame, DataFrame]:
    """Rows of the mask, and all others (null counts as false)."""
    sure = F.coalesce(mask, F.lit(False))
    return df.where(sure), df.where(~sure)


def _like(patterns: Sequence[str]) -> Column:
    return F.lit("|".join(f"(?:{fnmatch.translate(p)})" for p in patterns))


def matching(column: Column, patterns: Sequence[str]) -> Column:
    """Whether a name matches a shell pattern (fnmatch) wholly."""
    return F.rlike(column, F.concat(F.lit("^(?:"), _like([p for p in patterns]), F.lit(")$"))) if patterns else F.lit(False)


def select_runs(
    runs: DataFrame, stored: DataFrame | None = None, include_tags: Sequence[str] = (), exclude_tags: Sequence[str] = (), first: int | None = None,
    last: int | None = None, number: str = "number", tags: str = "tags", run: str = "run_id",
) -> DataFrame:
    """Runs with one of the tags and none of the others (shell patterns), in a range of numbers, with stored data if given."""
    any_of = lambda patterns: F.exists(F.col(tags), lambda t: matching(t, patterns))
    out = runs
    if include_tags:
        out = out.where(any_of(include_tags))
    if exclude_tags:
        out = out.where(~F.coalesce(any_of(exclude_tags), F.lit(False)))
    if first is not None:
        out = out.where(F.col(number) >= first)
    if last is not None:
        out = out.where(F.col(number) <= last)
    return out if stored is None else out.join(stored.select(run).distinct(), run, "left_semi")


def cable_map(df: DataFrame, channels: DataFrame, boards: DataFrame) -> DataFrame:
    """df with the board of its channel and the link of that board; unknown channels keep nulls."""
    return df.join(channels.select("channel", "board"), "channel", "left").join(boards.select("board", "link"), "board", "left")


def energy_spectrum(df: DataFrame, energy: str, lo: float, hi: float, n: int, exposure: float) -> DataFrame:
    """(bin, energy, count, rate, error): counts per bin, and per exposure and unit of energy."""
    from chronofold.operators.monitor import histogram

    step, scale = (hi - lo) / n, exposure * (hi - lo) / n
    h = histogram(df, F.col(energy), lo, hi, n)
    return h.select("bin", (F.lit(lo) + (F.col("bin") + 0.5) * step).alias("energy"), "count", (F.col("count") / scale).alias("rate"), (F.sqrt("count") / scale).alias("error"))


def smallest_mode(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """(by, mode): the commonest value, of equally common ones the smallest."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(*by).agg(F.min_by(value, F.struct(-F.col("n"), F.col(value))).alias("mode"))


def median_baseline(df: DataFrame, data: str = "data") -> DataFrame:
    """df with ``baseline``: the median of its samples (the mean of the middle two of an even number)."""
    s, n = F.sort_array(data), F.size(data)
    middle = (F.get(s, F.call_function("div", n - 1, F.lit(2)).cast("int")) + F.get(s, F.call_function("div", n, F.lit(2)).cast("int"))) / 2
    return df.withColumn("baseline", F.when(n > 0, middle))


def data_sizes(manifest: DataFrame, by: Sequence[str] = ("run_id", "data_type")) -> DataFrame:
    return manifest.groupBy(*by).agg(F.sum("n_bytes").alias("n_bytes"), F.count(F.lit(1)).alias("n_chunks"))


def split_seconds(ns: Column) -> tuple[Column, Column]:
    """Whole seconds, rounded down, and the nanoseconds that are left."""
    left = F.pmod(ns, F.lit(10**9))
    return F.call_function("div", ns - left, F.lit(10**9)), left


def local_time(ns: Column, zone: str) -> Column:
    """The wall-clock time of a zone, to the microsecond."""
    return F.from_utc_timestamp(F.timestamp_micros(F.call_function("div", ns, F.lit(1000))), zone)


def dataset_id(run: Column, kind: Column, lineage: Column, scope: str = "exp") -> Column:
    return F.concat(F.lit(f"{scope}_"), run, F.lit(":"), kind, F.lit("-"), lineage)


def parse_dataset_id(did: Column, scope: str = "exp") -> dict[str, Column]:
    """run_id, data_type and lineage of an identifier; empty where it is none."""
    return {name: F.regexp_extract(did, rf"^{re.escape(scope)}_([^:]+):(.+)-([^-]+)$", k) for k, name in enumerate(("run_id", "data_type", "lineage"), 1)}


def event_scatter(events: DataFrame, color: Column) -> DataFrame:
    """cs1, cs2 (0 where missing) and a colour of at most 0.9."""
    zero = lambda c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0))
    return events.select("run_id", "event_number", zero("cs1").alias("cs1"), zero("cs2").alias("cs2"), F.least(color, F.lit(0.9)).alias("color"))


def event_display(events: DataFrame, peaks: DataFrame, run: str, number: int) -> DataFrame:
    """Peaks that touch one event: a point lookup and a range that reaches the scan."""
    one = events.where((F.col("run_id") == run) & (F.col("event_number") == number)).select("time", "endtime").first()
    if one is None:
        return peaks.limit(0)
    return peaks.where((F.col("run_id") == run) & (F.col("time") < one.endtime) & (F.col("endtime") > one.time))


def child_options(parent: Mapping, own: Mapping, inherits: Mapping[str, str]) -> dict:
    """A child operator's options: the parent's, its own added, and those that inherit (child's name -> parent's name) put in the place of
    the parent's. A name that the parent does not know raises."""
    unknown = sorted(set(inherits.values()) - set(parent))
    if unknown:
        raise KeyError(f"the parent has no option {', '.join(unknown)}")
    return dict(parent) | dict(own) | {old: own[new] for new, old in inherits.items() if new in own}


def check_global_version(options: Mapping[str, object], global_version: str | None) -> None:
    """No option follows the online version while the global one is fixed."""
    if global_version and global_version.lower() != "online":
        online = sorted(k for k, v in options.items() if isinstance(v, str) and "version=ONLINE" in v)
        if online:
            raise ValueError(f"online versions under {global_version}: {', '.join(online)}")


def load_entry_points(group: str = "chronofold.operators") -> list[str]:
    """Calls register() of every installed entry point of the group; returns their names."""
    from importlib.metadata import entry_points

    names = []
    for point in entry_points(group=group):
        point.load()()
        names.append(point.name)
    return names
