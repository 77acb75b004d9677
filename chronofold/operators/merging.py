"""Merging of neighbouring signals: islands first, then gap after gap inside each island.

No merge bridges a gap over the widest allowed, so islands cut there never separate two rows that could merge. Islands run in batches,
see executor.py.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from chronofold.operators.executor import floats, lists, map_islands
from chronofold.operators.intervals import RUN, islands, outside
from chronofold.operators.ordered import HOUR, match

#: Points over log10 of the area: widest gap in ns, spread of the places in cm, goodness of split (fixed values).
GAPS = ((1.74, 5.02e3), (2.13, 4.18e3), (2.51, 3.26e3), (2.9, 3.25e3), (3.29, 3.04e3), (3.68, 2.67e3), (4.07, 2.31e3), (4.46, 2.05e3), (4.85, 1.89e3))
SPREADS = ((1.51, 14.0), (1.84, 18.3), (2.18, 19.7), (2.51, 12.4), (2.84, 5.75))
SPLITS = ((2.5, 1.0), (5.625, 0.4))


@dataclass(frozen=True)
class MergeRules:
    """gaps: widest gap by the merged area, whose first point also bounds every gap and whose last point the area; max_duration: merged
    peaks are shorter; splits: with it, no merge across a gap where the merged waveform splits better; spreads: with it, no merge of places
    that lie further apart; without_s1: S1s are left out from the start."""

    gaps: Sequence = GAPS
    max_duration: int = 30_000
    splits: Sequence | None = SPLITS
    spreads: Sequence | None = None
    without_s1: bool = True

    def widest(self) -> float:
        return self.gaps[0][1]

    def largest(self) -> float:
        return 10 ** self.gaps[-1][0]


def on_curve(log_area: float, points: Sequence) -> float:
    """Linear between the points, constant beyond them."""
    x, y = zip(*points)
    return float(np.interp(log_area, x, y))


def weighted_spread(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> float:
    """Weighted mean distance from the weighted centre; NaN if a weight is not positive or a place is missing."""
    if not len(w) or np.any(~(w > 0)) or np.isnan(x).any() or np.isnan(y).any():
        return float("nan")
    cx, cy = np.average(x, weights=w), np.average(y, weights=w)
    return float(np.average(np.hypot(x - cx, y - cy), weights=w))


def _spread_so_far(w: np.ndarray, t: np.ndarray) -> np.ndarray:
    n, s, ss = np.cumsum(w), np.cumsum(w * t), np.cumsum(w * t * t)
    return np.where(n > 0, ss - s * s / np.where(n > 0, n, 1), 0.0)


def split_across(samples: np.ndarray, times: np.ndarray, widths: np.ndarray) -> float:
    """The best goodness of a split of the samples (ascending times): 1 - (spread left + spread right) / spread, less where the waveform is high.
    A waveform in one sample has no spread to split (-1)."""
    w = np.maximum(samples, 0.0)
    left, right = _spread_so_far(w, times), _spread_so_far(w[::-1], times[::-1])[::-1]
    if left[-1] <= 1e-12 * float(np.sum(w * times * times)):
        return -1.0
    good = 1 - (left + right) / left[-1]
    height = w / widths
    if height.max() > 0:
        good = good * (1 - height / height.max())
    return min(float(good.max()), 1.0)  # rounding must not make a perfect split better than that


def merge_spans(
    time: np.ndarray, endtime: np.ndarray, area: np.ndarray, kind: np.ndarray, rules: MergeRules, waves: Sequence[tuple[np.ndarray, float]] | None = None,
    places: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None = None,
) -> list[tuple[int, int]]:
    """(first, last) of each merged peak, of the rows of one island in time order.

    Gaps are tried from the smallest on; the clusters on both sides become one unless the gap is too wide for their area, they would be too large or too long,
    lie too far apart, or split too well. waves: (samples, width of one) of each row, for the splits. places: x, y, weight, area seen by the top, for the
    spreads. A cluster that begins with S1s begins at its first S2; without one, or alone, it is none.
    """
    n = len(time)
    first, last = np.arange(n), np.arange(n)
    gaps = time[1:] - endtime[:-1]
    for i in np.argsort(gaps, kind="stable"):
        a, b = first[i], last[i + 1]
        part = slice(a, b + 1)
        size = float(np.sum(area[part]))
        if gaps[i] > rules.widest():
            break
        if size > rules.largest() or endtime[b] - time[a] >= rules.max_duration:
            continue
        log_size = math.log10(size) if size > 0 else -math.inf
        if size > 0 and gaps[i] > on_curve(log_size, rules.gaps):
            continue
        if rules.spreads is not None and places is not None:
            x, y, weight, top = (p[part] for p in places)
            tops = float(np.sum(top))
            if weighted_spread(x, y, weight) > on_curve(math.log10(tops) if tops > 0 else -math.inf, rules.spreads):
                continue
        if rules.splits is not None and waves is not None:
            own = waves[a : b + 1]
            widths = np.concatenate([np.full(len(w), d) for w, d in own])
            times = np.concatenate([float(time[a + k] - time[i + 1]) + d * (np.arange(len(w)) + 0.5) for k, (w, d) in enumerate(own)])
            if len(widths) and split_across(np.concatenate([w for w, _ in own]), times, widths) > on_curve(log_size, rules.splits):
                continue
        first[part], last[part] = a, b
    out = []
    for a in np.unique(first):
        b = int(last[a])
        while kind[a] != 2 and b - a > 1:
            a += 1
        if kind[a] == 2 and b > a:
            out.append((int(a), b))
    return out


def assign_merges(
    peaks: DataFrame, rules: MergeRules | None = None, data: str | None = None, dt: str = "dt", weight: str | None = None, key: str = "hit_id", by: Sequence[str] = RUN, width: int = HOUR
) -> DataFrame:
    """(by, key, cluster, merged): the key of the first peak of the merged peak that each peak goes into, its own for none.

    peaks: time, endtime, area, type; with data (and dt) the samples of each for the splits, with rules.spreads x, y, area_fraction_top and, if weight
    is given, a column whose inverse weighs the places (else the area seen by the top does).
    """
    rules = rules or MergeRules()
    waved, placed = data is not None and rules.splits is not None, rules.spreads is not None
    names = ["time", "endtime", "area", "type", key, *([data, dt] if waved else []), *(["x", "y", "area_fraction_top"] if placed else []), *([weight] if placed and weight else [])]
    rows = peaks.where("type <> 1") if rules.without_s1 else peaks
    marked = islands(rows.select(*by, *dict.fromkeys(names)), "endtime", int(rules.widest()), by, ("time", key), width)

    def kernel(batch: pa.RecordBatch, starts: np.ndarray) -> pa.RecordBatch:
        time, endtime = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("time", "endtime"))
        area, kind = floats(batch, "area"), floats(batch, "type")
        cluster, merged = np.arange(batch.num_rows), np.zeros(batch.num_rows, dtype=bool)
        ends = np.append(starts[1:], batch.num_rows)
        if waved:
            samples, offsets = lists(batch, data)
            steps = floats(batch, dt)
        if placed:
            top = area * floats(batch, "area_fraction_top")
            places = (floats(batch, "x"), floats(batch, "y"), 1 / floats(batch, weight) if weight else top, top)
        # Islands of one row have nothing to merge and cost nothing here.
        for a, b in zip(starts[ends - starts > 1], ends[ends - starts > 1]):
            waves = [(samples[offsets[i] : offsets[i + 1]], steps[i]) for i in range(a, b)] if waved else None
            for f, t in merge_spans(time[a:b], endtime[a:b], area[a:b], kind[a:b], rules, waves, tuple(p[a:b] for p in places) if placed else None):
                cluster[a + f : a + t + 1], merged[a + f : a + t + 1] = a + f, True
        keys = batch.column(key)
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in by), keys, keys.take(pa.array(cluster)), pa.array(merged)], names=[*by, key, "cluster", "merged"])

    out = StructType([*[marked.schema[c] for c in (*by, key)], StructField("cluster", marked.schema[key].dataType), StructField("merged", BooleanType())])
    return map_islands(marked, kernel, out, ("time", key), by)


def merge_s2(
    peaks: DataFrame, rules: MergeRules | None = None, data: str | None = None, dt: str = "dt", lone_hits: DataFrame | None = None, key: str = "hit_id", by: Sequence[str] = RUN, width: int = HOUR
) -> DataFrame:
    """(by, time, endtime, area, n_merged, first_id, x, y, type): merged peaks of type 2, with the area-weighted place of their parts.

    lone_hits: (time, endtime, area, key); those inside a merged peak add their area. With data the samples are added up too, in ``data`` on the finest dt of
    the parts.
    """
    found = assign_merges(peaks, rules, data, dt, None, key, by, width).where("merged")
    rows = match(peaks, found.select(*by, key, "cluster"), [*by, key])
    sums = {c: F.try_divide(F.sum(F.col(c) * F.col("area")), F.sum("area")) for c in "xy" if c in peaks.columns}
    out = rows.groupBy(*by, "cluster").agg(
        F.min("time").alias("time"), F.max("endtime").alias("endtime"), F.sum("area").alias("area"), F.count(F.lit(1)).alias("n_merged"), *[v.alias(c) for c, v in sums.items()],
        *([F.sort_array(F.collect_list(F.struct("time", F.col(dt).alias("dt"), F.col(data).alias("data")))).alias("_parts")] if data else []),
    )
    if lone_hits is not None:
        from chronofold.operators.intervals import split_by_containment

        held = split_by_containment(lone_hits.select(*by, "time", "endtime", "area"), out.select(*by, "time", "endtime", "cluster"), "cluster", by, width)
        extra = held.groupBy(*by, "cluster").agg(F.sum("area").alias("_area"))
        out = match(out, extra, [*by, "cluster"], "left").withColumn("area", F.col("area") + F.coalesce("_area", F.lit(0))).drop("_area")
    if data:
        out = _with_sum(out, by)
    named = out.withColumnRenamed("cluster", "first_id").withColumn("type", F.lit(2))
    return named.select(*by, "time", "endtime", "area", "n_merged", "first_id", *sums, "type", *(["data", "dt"] if data else []))


def _with_sum(merged: DataFrame, by: Sequence[str]) -> DataFrame:
    """_parts of each merged peak added up on the finest dt, a sample of a coarser part spread evenly."""
    from pyspark.sql.types import ArrayType, DoubleType

    def run(batches):
        for batch in batches:
            begins, parts = batch.column("time").to_pylist(), batch.column("_parts").to_pylist()
            ends, data, steps = batch.column("endtime").to_pylist(), [], []
            for t0, t1, own in zip(begins, ends, parts):
                fine = math.gcd(*(int(p["dt"]) for p in own))
                total = np.zeros(-(-(t1 - t0) // fine))
                for p in own:
                    k = int(p["dt"]) // fine
                    spread = np.repeat(np.asarray(p["data"] or [], dtype=float) / k, k)[: len(total) - (p["time"] - t0) // fine]
                    at = (p["time"] - t0) // fine
                    total[at : at + len(spread)] += spread
                data.append(total.tolist())
                steps.append(fine)
            at = batch.schema.get_field_index("_parts")
            yield batch.remove_column(at).append_column("data", pa.array(data, pa.list_(pa.float64()))).append_column("dt", pa.array(steps, pa.int64()))

    out = StructType([*[f for f in merged.schema if f.name != "_parts"], StructField("data", ArrayType(DoubleType())), StructField("dt", LongType())])
    return merged.mapInArrow(run, out)


def replace_merged(peaks: DataFrame, merged: DataFrame, pass_types: Sequence[int] = (1, 20), key: str = "hit_id", by: Sequence[str] = RUN, width: int = HOUR) -> DataFrame:
    """Peaks that lie in a merged one give way to it; pass_types stay."""
    through = peaks.where(F.col("type").isin(*pass_types))
    rest = outside(peaks.where(~F.col("type").isin(*pass_types)), merged, key, by, width)
    kept = through.unionByName(rest).withColumn("merged", F.lit(False))
    return kept.unionByName(merged.withColumn("merged", F.lit(True)))


def whole_pulses(fragments: DataFrame, intervals: DataFrame, pulse: Sequence[str], key: str, by: Sequence[str] = RUN, width: int = HOUR) -> DataFrame:
    """All fragments of every pulse of which one fragment overlaps an interval."""
    from chronofold.operators.intervals import overlap_join

    met = overlap_join(fragments.select(*by, "time", "endtime", *[c for c in pulse if c not in by]), intervals.select(*by, "time", "endtime"), by, width)
    return match(fragments, met.select(*dict.fromkeys([*by, *pulse])).distinct(), list(dict.fromkeys([*by, *pulse])), "left_semi")
