"""Merging of peaklets by posterior probability.

A cluster grows from the largest free peaklet. Its deciles are samples of a normal pulse, whose posterior over a grid of centres and
widths predicts the area next to it; a neighbour joins while what it adds is likely enough, and is set aside if it lies too far off in
the plane. Only the choice of clusters needs numpy, one island of close peaklets at a time; areas, types and single hits are added by
DataFrame operations. Islands are exact: no cluster reaches over a gap of max_gap. An island is one group.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from chronofold.operators.executor import floats, lists, map_islands
from chronofold.operators.intervals import RUN, islands, split_by_containment
from chronofold.operators.merging import GAPS, SPREADS, on_curve, weighted_spread
from chronofold.operators.ordered import HOUR, match
from chronofold.session import pinned

#: Types of a peaklet set aside by its place, and of a merged peak with too much set aside (fixed values).
FAR, WIDE = 20, 22
#: p-values over log10 of the area, and the most that may be set aside: number, area, share (fixed values).
P_VALUES = ((4.18, 9.89e-4), (4.51, 7.15e-3), (4.84, 1.60e-1))
SET_ASIDE = (1, 49.5, 0.01)


@dataclass(frozen=True)
class Settings:
    """gain and gain_spread: area of one electron; sigmas: (least, greatest, number) of the widths tried; centres: number of places tried;
    poisson_below: up to so many expected electrons their number is Poisson; tail: the part of it that is left out."""

    max_duration: int = 30_000
    gaps: Sequence = GAPS
    p_values: Sequence = P_VALUES
    spreads: Sequence = SPREADS
    gain: float = 30.0
    gain_spread: float = 6.5
    sigmas: tuple = (1e2, 2e4, 10)
    centres: int = 10
    poisson_below: float = 25.0
    tail: float = 1e-4
    normal_grid: tuple = (7.0, 501)
    by_probability: bool = True
    by_place: bool = True
    likelier_first: bool = False
    max_gap: float = field(default=-1)

    def widest_gap(self) -> float:
        return self.max_gap if self.max_gap >= 0 else self.gaps[0][1]


class Normal:
    """Distribution function of the standard normal on a grid, linear between its points."""

    def __init__(self, most: float, n: int):
        self.z = np.linspace(-most, most, n)
        self.below = np.array([0.5 * math.erfc(-z / math.sqrt(2)) for z in self.z])

    def __call__(self, z):
        return np.interp(z, self.z, self.below)


def joined_deciles(a: dict, b: dict) -> tuple[float, np.ndarray]:
    """(median time, deciles from it) of a peak made of a and then b; times count from the start of a."""
    share = a["area"] / (a["area"] + b["area"])
    levels = np.linspace(0, 1, 11)
    filled = np.concatenate([levels * share, share + levels * (1 - share)])
    reached = np.concatenate([a["deciles"] + a["median"], b["deciles"] + b["median"] + b["time"] - a["time"]])
    at = np.interp(levels, filled, reached)
    return float(at[5]), at - at[5]


def joined(a: dict, b: dict) -> dict:
    median, deciles = joined_deciles(a, b)
    return {"time": a["time"], "endtime": b["endtime"], "area": a["area"] + b["area"], "median": median, "deciles": deciles}


def core_gap(a: dict, b: dict) -> float:
    """Distance between the central 80 % of two peaks."""
    ends = sorted(p["time"] - a["time"] + int(p["deciles"][k] + p["median"]) for p in (a, b) for k in (1, 9))
    return ends[2] - ends[1]


def electrons_p(expected: np.ndarray, area: float, s: Settings, normal: Normal) -> np.ndarray:
    """Probability of at least that area, for each expected number of electrons."""
    out = 1 - normal((area / s.gain - expected) / np.sqrt(np.maximum(expected, 1e-300)))
    few = expected <= s.poisson_below
    if few.any():
        mu = expected[few][:, None]
        k = np.arange(1, int(s.poisson_below + 10 * math.sqrt(s.poisson_below)) + 20)
        log_factorial = np.cumsum(np.log(k))
        mass = np.exp(k * np.log(np.maximum(mu, 1e-300)) - mu - log_factorial)
        before = np.exp(-mu) + np.cumsum(mass, axis=1) - mass
        beyond = 1 - normal((area - k * s.gain) / (np.sqrt(k) * s.gain_spread))
        out[few] = np.where(before < 1 - s.tail, mass * beyond, 0).sum(1)
    return out


def p_value(seen: dict, other: dict, seen_bounds: tuple, other_bounds: tuple, s: Settings, normal: Normal) -> float:
    """Probability, averaged over the posterior of the pulse behind ``seen``, of an area as large as that of ``other`` in its bounds."""
    t0 = seen["time"]
    mu = np.linspace(min(seen["time"], other["time"]) - t0, max(seen["endtime"], other["endtime"]) - t0, s.centres)[:, None]
    sigma = np.linspace(*s.sigmas)[None, :]
    inside = lambda b: normal((b[1] - t0 - mu) / sigma) - normal((b[0] - t0 - mu) / sigma) + np.finfo(float).eps
    here, there = inside(seen_bounds), inside(other_bounds)
    n = seen["area"] / s.gain
    edges = seen["deciles"] + seen["median"]
    samples = (edges[1:] + edges[:-1]) / 2
    distance = seen["time"] - other["time"] + seen["median"] - other["median"]
    log_density = -((samples - mu) ** 2).sum(1, keepdims=True) * n / 10 / (2 * sigma**2)
    log_density = log_density - np.log(here) * n - np.log(sigma) * (n + 2) - distance**2 / (8 * sigma**2)
    weight = np.exp(log_density - log_density.max())
    weight /= weight.sum()
    return float((weight.ravel() * electrons_p((there / here * n).ravel(), other["area"], s, normal)).sum())


def grow_clusters(peaks: list[dict], s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(first, kept) of disjoint peaks in time order: the first row of each row's cluster, and whether it is not set aside."""
    n, normal, widest = len(peaks), Normal(*s.normal_grid), s.widest_gap()
    free, kept, first = np.ones(n, bool), np.ones(n, bool), np.arange(n)
    middle = [(a["endtime"] + b["time"]) // 2 for a, b in zip(peaks, peaks[1:])]
    starts = [max(p["time"] - int(widest / 2), *([middle[i - 1]] if i else [p["time"] - int(widest / 2)])) for i, p in enumerate(peaks)]
    ends = [min(p["endtime"] + int(widest / 2), *([middle[i]] if i < n - 1 else [p["endtime"] + int(widest / 2)])) for i, p in enumerate(peaks)]

    def offer(cluster: dict, lo: int, hi: int, j: int) -> tuple[float, bool]:
        """(p, whether it passes) of adding peak j; p is -1 where it cannot be added."""
        if not (0 <= j < n and free[j]):
            return -1.0, False
        other = peaks[j]
        gap = core_gap(cluster, other)
        size = cluster["area"] + other["area"]
        if gap >= widest or max(cluster["endtime"], other["endtime"]) - min(cluster["time"], other["time"]) > s.max_duration:
            return -1.0, False
        log_area = math.log10(size) if size > 0 else -math.inf
        if gap >= on_curve(log_area, s.gaps):
            return -1.0, False
        if not other["area"] > 0 or not s.by_probability:
            return 1.0, True
        p = p_value(cluster, other, (starts[lo], ends[hi]), (starts[j], ends[j]), s, normal)
        return p, p >= on_curve(log_area, s.p_values)

    for seed in sorted(range(n), key=lambda i: (-peaks[i]["area"], -i)):
        if not free[seed]:
            continue
        lo = hi = seed
        cluster = peaks[seed]
        while True:
            sides = {j: offer(cluster, lo, hi, j) for j in (lo - 1, hi + 1)}
            passing = [j for j in sides if sides[j][1]]
            if not passing:
                break
            # The likelier or larger side first; the right one of equals.
            j = max(passing, key=lambda j: (sides[j][0] if s.likelier_first else peaks[j]["area"], j))
            near = True
            if s.by_place:
                rows = [i for i in range(min(lo, j), max(hi, j) + 1) if kept[i]]
                weights = np.array([peaks[i]["weight"] for i in rows])
                tops = sum(peaks[i]["area_top"] for i in rows)
                spread = weighted_spread(*(np.array([peaks[i][c] for i in rows], float) for c in "xy"), weights)
                near = tops > 0 and spread < on_curve(math.log10(tops), s.spreads)
            if near:
                cluster = joined(peaks[j], cluster) if j < lo else joined(cluster, peaks[j])
            else:
                kept[j] = False
            lo, hi = min(lo, j), max(hi, j)
        free[lo : hi + 1] = False
        first[lo : hi + 1] = lo
    return first, kept


def assign_clusters(
    peaklets: DataFrame, settings: Settings | None = None, weight: str | None = None, key: str = "peaklet", by: Sequence[str] = RUN, width: int = HOUR
) -> DataFrame:
    """(by, key, time, endtime, area, cluster, size, kept) of type-2 peaklets: the key of the first peaklet of the cluster, its number of
    peaklets, and whether this one is not set aside.

    Needs disjoint peaklets with median_time, area_decile_from_midpoint (11), area_fraction_top, x, y. weight: a column whose inverse
    weighs the places (the area of a position's contour); else the area seen by the top does.
    """
    s = settings or Settings()
    names = ["time", "endtime", "area", "median_time", "area_decile_from_midpoint", "area_fraction_top", "x", "y", key, *([weight] if weight else [])]
    marked = islands(peaklets.where("type = 2").select(*by, *dict.fromkeys(names)), "endtime", int(s.widest_gap()), by, ("time", key), width)

    def choose(batch: pa.RecordBatch, starts: np.ndarray) -> pa.RecordBatch:
        n = batch.num_rows
        ends = np.append(starts[1:], n)
        time, endtime = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("time", "endtime"))
        inside = np.ones(max(n - 1, 0), dtype=bool)
        inside[starts[1:] - 1] = False
        if (inside & (time[1:] < endtime[:-1])).any():
            raise ValueError("peaklets overlap")
        area, median, share, x, y = (floats(batch, c) for c in ("area", "median_time", "area_fraction_top", "x", "y"))
        top = area * share
        weights = np.where(floats(batch, weight) != 0, 1 / floats(batch, weight), np.nan) if weight else top
        deciles, at = lists(batch, "area_decile_from_midpoint")
        first, kept, size = np.arange(n), np.ones(n, dtype=bool), np.ones(n, dtype=np.int64)
        for a, b in zip(starts[ends - starts > 1], ends[ends - starts > 1]):
            rows = [
                {"time": int(time[i]), "endtime": int(endtime[i]), "area": float(area[i]), "median": float(median[i]), "deciles": deciles[at[i] : at[i + 1]], "x": x[i], "y": y[i],
                 "area_top": top[i], "weight": weights[i]} for i in range(a, b)
            ]
            own, left = grow_clusters(rows, s)
            first[a:b], kept[a:b], size[a:b] = a + own, left, np.bincount(own)[own]
        keys = batch.column(key)
        carried = [batch.column(c) for c in (*by, key, "time", "endtime", "area")]
        return pa.RecordBatch.from_arrays([*carried, keys.take(pa.array(first)), pa.array(size), pa.array(kept)], names=[*by, key, "time", "endtime", "area", "cluster", "size", "kept"])

    fields = [marked.schema[c] for c in (*by, key, "time", "endtime", "area")]
    out = StructType([*fields, StructField("cluster", marked.schema[key].dataType), StructField("size", LongType()), StructField("kept", BooleanType())])
    return map_islands(marked, choose, out, ("time", key), by)


def merged_peaks(
    assigned: DataFrame, others: DataFrame | None = None, lone_hits: DataFrame | None = None, most: Sequence[float] = SET_ASIDE, key: str = "peaklet", lone_key: str = "hit_id",
    by: Sequence[str] = RUN, width: int = HOUR,
) -> DataFrame:
    """(by, cluster, time, endtime, area, n_merged, n_aside, type) of clusters of several peaklets: type 2, or 22 with too much set aside.

    others: peaklets of type 0, lone_hits: hits; those fully inside a merged peak add their area, the former their number as well.
    """
    inside = F.col("kept")
    peaks = assigned.where("size > 1").groupBy(*by, "cluster").agg(
        F.min(F.when(inside, F.col("time"))).alias("time"), F.max(F.when(inside, F.col("endtime"))).alias("endtime"), F.sum(F.when(inside, F.col("area")).otherwise(0)).alias("area"),
        F.count_if(inside).alias("n_merged"), F.count_if(~inside).alias("n_aside"), F.sum(F.when(~inside, F.col("area")).otherwise(0)).alias("aside"),
    )
    wide = (F.col("n_aside") > most[0]) | ((F.col("aside") > most[1]) & (F.col("aside") > F.col("area") * most[2]))
    out = pinned(peaks.withColumn("type", F.when(wide, F.lit(WIDE)).otherwise(F.lit(2))).drop("aside"))
    added, frames = out.select(*by, "cluster", "time", "endtime"), []
    if others is not None:
        held = split_by_containment(others.where("type = 0").select(*by, "time", "endtime", key, "area"), added, "cluster", by, width)
        frames.append(held.select(*by, "cluster", "area", F.lit(1).alias("n")))
    if lone_hits is not None:
        held = split_by_containment(lone_hits.select(*by, "time", "endtime", lone_key, "area"), added, "cluster", by, width)
        frames.append(held.select(*by, "cluster", "area", F.lit(0).alias("n")))
    for f in frames:
        more = f.groupBy(*by, "cluster").agg(F.sum("area").alias("_area"), F.sum("n").alias("_n"))
        out = match(out, more, [*by, "cluster"], "left")
        out = out.withColumns({"area": F.col("area") + F.coalesce("_area", F.lit(0)), "n_merged": F.col("n_merged") + F.coalesce("_n", F.lit(0))}).drop("_area", "_n")
    return out


def enhanced_types(peaklets: DataFrame, assigned: DataFrame, merged: DataFrame | None = None, key: str = "peaklet", by: Sequence[str] = RUN, width: int = HOUR) -> DataFrame:
    """(by, key, type, merged): type 20 for peaklets set aside; merged says whether one went into a merged peak (of type 0: with merged given)."""
    flags = assigned.select(*by, key, (~F.col("kept")).alias("_far"), (F.col("kept") & (F.col("size") > 1)).alias("_in"))
    if merged is not None:
        held = split_by_containment(peaklets.where("type = 0").select(*by, "time", "endtime", key), merged.select(*by, "time", "endtime", "cluster"), "cluster", by, width)
        flags = flags.unionByName(held.select(*by, key, F.lit(False).alias("_far"), F.lit(True).alias("_in")))
    far = F.coalesce("_far", F.lit(False))
    return match(peaklets, flags, [*by, key], "left").select(*by, key, F.when(far, FAR).otherwise(F.col("type")).alias("type"), F.coalesce("_in", F.lit(False)).alias("merged"))
