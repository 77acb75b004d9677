"""From hits to peaklets and veto events: clustering, integration bounds, sums over samples, timing features, high-energy veto.

All group by (run, ...) and run over the interval algebra; only peaklets that outgrow the longest duration are cut in a
grouped map, one gap-free group at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronofold.operators import ordered
from chronofold.operators.intervals import RUN, coincidence, islands, merge_intervals, overlap_join, split_by_containment
from chronofold.operators.ordered import HOUR, match
from chronofold.session import pinned


def find_peaklets(
    hits: DataFrame, gap: int, left: int = 0, right: int = 0, min_channels: int = 1, max_duration: int | None = None,
    by: Sequence[str] = RUN, key: str = "hit_id", width: int = HOUR,
) -> DataFrame:
    """(by, peaklet, time, endtime, n_hits, n_channels, area): hits that follow each other within gap, extended by left and right,
    with at least min_channels different channels; numbered in time order.

    A cluster longer than max_duration is cut before the hit that would make it so.
    """
    marked = islands(hits.select(*by, "time", "endtime", key, "channel", "area"), "endtime", gap, by, ("time", key), width)
    part = F.lit(0)
    if max_duration is not None:
        sizes = marked.groupBy(*by, "island").agg((F.max("endtime") - F.min("time") + left + right > max_duration).alias("long"))
        sized, columns = match(marked, sizes, [*by, "island"]), [*marked.columns, "part"]

        def cut(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(["time", key])
            parts, number, start = [], 0, None
            for t, e in zip(pdf.time, pdf.endtime):
                if start is not None and e - start + left + right > max_duration:
                    number, start = number + 1, None
                start = t if start is None else start
                parts.append(number)
            return pdf.assign(part=parts)[columns]

        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in marked.schema.fields)
        long = sized.where("long").drop("long").groupBy(*by, "island").applyInPandas(cut, f"{schema}, part int")
        marked, part = sized.where("not long").drop("long").withColumn("part", F.lit(0)).unionByName(long), F.col("part")
    clusters = marked.withColumn("part", part).groupBy(*by, "island", "part").agg(
        (F.min("time") - left).alias("time"), (F.max("endtime") + right).alias("endtime"), F.count(F.lit(1)).alias("n_hits"),
        F.countDistinct("channel").alias("n_channels"), F.sum("area").alias("area"),
    )
    kept = pinned(clusters.where(F.col("n_channels") >= min_channels).drop("island", "part"))
    return ordered.row_numbers(kept, "peaklet", by, ("time",), width)


def integration_bounds(
    hits: DataFrame, left: int, right: int, by: Sequence[str] = ("run_id", "channel"), key: str = "hit_id", width: int = HOUR,
    lowest: int | None = None, highest: int | None = None,
) -> DataFrame:
    """hits with left_bound and right_bound: extended by left and right, never into the next hit of the channel, nor into what the
    hit before it took, nor beyond lowest and highest."""
    rows = ordered.neighbours(hits, ["endtime"], ["time"], by, ("time", key), width)
    taken = F.least(F.col("prev_endtime") + right, F.col("time"))
    start = F.greatest(F.col("time") - left, F.coalesce(taken, F.col("time") - left))
    end = F.least(F.col("endtime") + right, F.greatest(F.coalesce("next_time", F.col("endtime") + right), F.col("endtime")))
    if lowest is not None:
        start = F.greatest(start, F.lit(lowest))
    if highest is not None:
        end = F.least(end, F.lit(highest))
    return rows.select(*hits.columns, start.alias("left_bound"), end.alias("right_bound"))


def integrate(df: DataFrame, data: str, first: str, last: str) -> DataFrame:
    """df with ``integral``: the sum of samples first to last (exclusive) of the array data."""
    part = F.slice(F.col(data), F.col(first).cast("int") + 1, F.greatest((F.col(last) - F.col(first)).cast("int"), F.lit(0)))
    return df.withColumn("integral", F.aggregate(part, F.lit(0).cast("long"), lambda a, x: a + x))


def sum_waveform(
    peaklets: DataFrame, hitlets: DataFrame, dt: int, peaklet: str = "peaklet", data: str = "data", by: Sequence[str] = RUN, width: int = HOUR
) -> DataFrame:
    """(by, peaklet, sample, value): samples of the hitlets that begin inside a peaklet, summed at their places in it; samples beyond
    its end are left out."""
    lean = peaklets.select(*by, "time", "endtime", peaklet)
    met = overlap_join(hitlets.select(*by, "time", data), lean, by, width, "starting")
    flat = met.select(*by, F.col(f"w_{peaklet}").alias(peaklet), "time", "w_time", "w_endtime", F.posexplode(data).alias("i", "v"))
    at = F.col("time") + F.col("i") * F.lit(dt)
    inside = flat.where(at < F.col("w_endtime"))
    return inside.groupBy(*by, peaklet, F.call_function("div", at - F.col("w_time"), F.lit(dt)).alias("sample")).agg(F.sum("v").alias("value"))


def hit_features(peaklets: DataFrame, hits: DataFrame, peaklet: str = "peaklet", at: str = "center_time", by: Sequence[str] = RUN, key: str = "hit_id", width: int = HOUR) -> DataFrame:
    """(by, peaklet, max_diff, min_diff, first_channel, last_channel): gaps between the maxima of the hits inside, and the channels of
    the first and the last; -1 where there is none."""
    inside = split_by_containment(hits.select(*by, "time", "endtime", at, key, "channel"), peaklets.select(*by, "time", "endtime", peaklet), peaklet, by, width)
    w = Window.partitionBy(*by, peaklet).orderBy(at, key)
    gaps = inside.withColumn("gap", F.col(at) - F.lag(at).over(w))
    found = gaps.groupBy(*by, peaklet).agg(
        F.max("gap").alias("max_diff"), F.min("gap").alias("min_diff"), F.min_by("channel", F.struct(at, key)).alias("first_channel"),
        F.max_by("channel", F.struct(at, key)).alias("last_channel"),
    )
    out = match(peaklets.select(*by, peaklet), found, [*by, peaklet], "left")
    return out.select(*by, peaklet, *[F.coalesce(c, F.lit(-1).cast("long")).alias(c) for c in ("max_diff", "min_diff", "first_channel", "last_channel")])


def veto_events(hitlets: DataFrame, n: int, resolving: int, pre: int = 0, by: Sequence[str] = RUN, key: str = "hit_id", width: int = HOUR) -> DataFrame:
    """(by, event_number, time, endtime, n_hits): the hitlets that touch each n-fold coincidence; coincidences that share a hitlet
    are one event, which begins with its first hitlet and ends with its last."""
    lean = pinned(hitlets.select(*by, "time", "endtime", key))
    spans = pinned(coincidence(lean, n, resolving, pre, by, key, width))
    place = F.struct("time", F.col(key).alias("key"))
    met = overlap_join(lean, spans.withColumn("span", F.col("time")), by, width)
    ranges = met.groupBy(*by, "w_span").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    # Ranges of hitlets in order: one begins anew where its first hitlet comes after the last of all ranges before it. A range opens at its
    # first hitlet as far as its bucket goes; those that earlier buckets reach fall away, and so does what follows up to the next that stands.
    opens = lambda reach: F.coalesce(F.col("first") > F.col(reach), F.lit(True))
    rows = ordered.parted(ranges.withColumn("time", F.col("first.time")), by, width)
    local = F.max("last").over(ordered.within_part(["first", "last"]).rowsBetween(Window.unboundedPreceding, -1))
    rows = ordered.carried(rows, {"_reach": F.max("last")}, {"_reach": F.max}, by).withColumn("_local", local)
    starts = pinned(rows.select(*by, "time", "first", "last", (opens("_reach") & opens("_local")).alias("new")))
    opened = F.when(F.col("new"), F.col("first"))
    named = ordered.fill_forward(starts.withColumn("_open", opened), "_open", "event", by, ("time", "first", "last"), width)
    events = named.groupBy(*by, "event").agg(F.max("last").alias("last")).select(*by, F.col("event.time").alias("time"), F.col("event").alias("first"), "last")
    # Every hitlet from an event's first to its last: the last event that opens at or before it, if that has not ended.
    span = F.struct("first", "last")
    marks = events.select(*by, "time", F.col("first.key").alias(key), F.lit(0).alias("side"), F.lit(None).cast("long").alias("endtime"), span.alias("span"))
    both = lean.select(*by, "time", key, F.lit(1).alias("side"), F.col("endtime").cast("long").alias("endtime"), F.lit(None).cast(marks.schema["span"].dataType).alias("span"))
    filled = ordered.fill_forward(pinned(both.unionByName(marks)), "span", "event", by, ("time", key, "side"), width).where("side = 1")
    inside = filled.where(F.struct("time", F.col(key).alias("key")) <= F.col("event.last"))
    found = inside.groupBy(*by, "event").agg(F.min("time").alias("time"), F.max("endtime").alias("endtime"), F.count(F.lit(1)).alias("n_hits")).drop("event")
    return ordered.row_numbers(pinned(found), "event_number", by, ("time",), width)


def rough_sum(records: DataFrame, regions: DataFrame, dt: int, region: str = "region", by: Sequence[str] = RUN, width: int = HOUR) -> DataFrame:
    """(by, region, bin, area): areas of the records that begin in a region, in bins of dt from its start."""
    met = overlap_join(records.select(*by, "time", "area"), regions.select(*by, "time", "endtime", region), by, width, "starting").where("time < w_endtime")
    at = F.call_function("div", F.col("time") - F.col("w_time"), F.lit(dt))
    return met.groupBy(*by, F.col(f"w_{region}").alias(region), at.alias("bin")).agg(F.sum("area").alias("area"))


def high_energy_veto(
    peaks: DataFrame, records: DataFrame, min_area: int, duration: int, dt: int, fraction: float, extension: int, by: Sequence[str] = RUN, width: int = HOUR
) -> DataFrame:
    """(by, time, endtime): what to leave out after big peaks. Of the ``duration`` from a big peak on, bins of dt whose rough sum is over
    fraction of the region's largest pass, with extension on both sides; the rest is vetoed, but for pieces of at most two extensions."""
    big = peaks.where(F.col("area") > min_area).select(*by, "time", (F.col("time") + duration).alias("endtime"), F.col("time").alias("region"))
    regions = merge_intervals(big, by, width).withColumn("region", F.col("time"))
    regions = pinned(regions)
    sums = rough_sum(records, regions, dt, "region", by, width)
    top = sums.withColumn("top", F.max("area").over(Window.partitionBy(*by, "region"))).where(F.col("area") > F.col("top") * fraction)
    passed = top.select(*by, "region", (F.col("region") + F.col("bin") * dt - extension).alias("a"), (F.col("region") + (F.col("bin") + 1) * dt + extension).alias("b"))
    edge = regions.select(*by, "region", F.col("endtime").alias("a"), F.col("endtime").alias("b"))
    w = Window.partitionBy(*by, "region").orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)
    gaps = passed.unionByName(edge).withColumn("reach", F.coalesce(F.max("b").over(w), F.col("region")))
    held = gaps.select(*by, F.col("reach").alias("time"), F.col("a").alias("endtime"))
    return held.where(F.col("endtime") - F.col("time") > 2 * extension)


def first_seconds(records: DataFrame, start: int, seconds: float, fragment: str = "record_i", length: str = "length", dt: str = "dt") -> DataFrame:
    """Records of pulses that begin in the first seconds of a run, whichever fragment they are."""
    began = F.col("time") - F.col(fragment).cast("long") * F.col(length) * F.col(dt)
    return records.where(began < start + int(seconds * 1e9))


def lone_record_statistics(records: DataFrame, by: Sequence[str] = ("run_id", "channel"), fragment: str = "record_i") -> DataFrame:
    """Per channel: lone records and further fragments, mean area and mean baseline of the former (fragment 0)."""
    first = F.col(fragment) == 0
    return records.groupBy(*by).agg(
        F.count_if(first).alias("n_lone"), F.count_if(~first).alias("n_fragments"), F.avg(F.when(first, F.col("area"))).alias("mean_area"),
        F.avg(F.when(first, F.col("baseline"))).alias("mean_baseline"),
    )


def pulse_delay(hitlets: DataFrame, pulses: DataFrame, at: str = "center_time", by: Sequence[str] = ("run_id", "channel"), key: str = "hit_id", width: int = HOUR) -> DataFrame:
    """(by, key, pulse, delta_time): the disjoint pulse of the same channel that holds each hitlet, and the time from its start."""
    inside = split_by_containment(hitlets.select(*by, "time", "endtime", key, at), pulses.select(*by, "time", "endtime", F.col("time").alias("pulse")), "pulse", by, width)
    return inside.select(*by, key, "pulse", (F.col(at) - F.col("pulse")).alias("delta_time"))


def match_clock(pulses: DataFrame, truths: DataFrame, before: int, after: int, key: str = "hit_id", truth: str = "truth", by: Sequence[str] = RUN, width: int = HOUR) -> DataFrame:
    """(by, key, truth): the truth times from ``before`` ahead of a pulse to ``after`` behind its start, one row each."""
    windows = pulses.select(*by, (F.col("time") - before).alias("time"), (F.col("time") + after).alias("endtime"), key)
    met = overlap_join(truths.select(*by, F.col(truth).alias("time")), windows, by, width, "starting")
    return met.select(*by, F.col(f"w_{key}").alias(key), F.col("time").alias(truth))


def clock_edges(records: DataFrame, threshold: float, offset: int = 0, baseline_samples: int = 40, data: str = "data", key: str = "hit_id", by: Sequence[str] = RUN) -> DataFrame:
    """(by, key, time): where the pulses of a clock channel rise by threshold below their baseline. A run without any such edge gives the starts
    of its first fragments, ``offset`` later."""
    from chronofold.operators import waveform as wf

    def edges(samples):
        return [h[0] for h in wf.find_hits(wf.process_pulse(samples, baseline_samples)[0], threshold)]

    found = wf.with_arrays(records.select(*by, key, "time", "dt", "record_i", data), [*by, key, "time", "dt", "record_i"], data, edges, "array<int>")
    marks = pinned(found.withColumnRenamed("result", "edges"))
    seen = marks.where(F.size("edges") > 0)
    risen = seen.select(*by, key, "time", "dt", F.explode("edges").alias("at")).select(*by, key, (F.col("time") + F.col("at") * F.col("dt")).alias("time"))
    silent = match(marks.where("record_i = 0"), seen.select(*by).distinct(), by, "left_anti")
    return risen.unionByName(silent.select(*by, key, (F.col("time") + offset).alias("time")))
