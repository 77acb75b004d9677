"""Array-per-row operators: waveforms, channel patterns, hit finding and splitting.

Sums, maxima, slices and histograms are built-in array expressions. What walks along the samples (hits, widths,
splitting, smoothing) runs in Arrow batches over numpy.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def total(data: Column) -> Column:
    return F.aggregate(data, F.lit(0).cast("long"), lambda a, x: a + x)


def peak_basics(df: DataFrame, data: str = "area_per_channel", n_top: int = 253) -> DataFrame:
    """n_channels, top_n_channels, max_channel (0-based, the first maximum), max_channel_area, area, area_fraction_top."""
    c = F.col(data)
    positive = lambda x: x > 0
    top = F.slice(c, 1, n_top)
    return df.withColumns({
        "n_channels": F.size(F.filter(c, positive)),
        "top_n_channels": F.size(F.filter(top, positive)),
        "max_channel": (F.array_position(c, F.array_max(c)) - 1).cast("int"),
        "max_channel_area": F.array_max(c),
        "area": total(c),
        "area_fraction_top": F.try_divide(total(top).cast("double"), total(c)),
    })


def check_area(df: DataFrame, data: str = "area_per_channel", area: str = "area", rtol: float = 1e-5) -> DataFrame:
    """df; raises if a positive area differs from the sum over channels by more than rtol."""
    off = F.abs(total(F.col(data)) - F.col(area)) > 1e-8 + rtol * F.abs(F.col(area))
    bad = (F.col(area) > 0) & off
    return df.withColumn(area, F.when(bad, F.raise_error(F.lit("area differs from the sum over channels")).cast("double")).otherwise(F.col(area)))


def sum_waveforms(df: DataFrame, data: str = "data", by: Sequence[str] = ()) -> DataFrame:
    """(by, sample, value): element-wise sums, combined on the map side."""
    flat = df.select(*by, F.posexplode(data).alias("sample", "value"))
    return flat.groupBy(*by, "sample").agg(F.sum("value").alias("value"))


def records_matrix(df: DataFrame, samples_per_bin: int, data: str = "data", channel: str = "channel") -> DataFrame:
    """(time_bin, channel, value): samples summed per channel and bin of samples."""
    flat = df.select(F.col(channel).alias("channel"), F.posexplode(data).alias("sample", "value"))
    return flat.groupBy(F.expr(f"sample div {samples_per_bin}").alias("time_bin"), "channel").agg(F.sum("value").alias("value"))


def downsampling(length: int, n_rows: int, max_samples: int) -> int:
    """Samples to sum into one bin so that a matrix of n_rows keeps below max_samples."""
    factor = 1
    while length * n_rows / factor > max_samples:
        factor *= 2
    return factor


def top_bottom(df: DataFrame, data: str = "data", top: str = "data_top", dt: str = "dt") -> DataFrame:
    """Adds data_bottom, the areas and area-weighted centre times of both arrays, and their difference."""
    bottom = F.zip_with(F.col(data), F.col(top), lambda a, b: a - b)
    centre = lambda c: F.try_divide(
        F.aggregate(F.transform(c, lambda x, i: x * i), F.lit(0.0), lambda a, x: a + x) * F.col(dt), F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    )
    out = df.withColumn("data_bottom", bottom)
    out = out.withColumns({"center_time_top": centre(F.col(top)), "center_time_bottom": centre(F.col("data_bottom"))})
    return out.withColumn("center_time_diff", F.col("center_time_top") - F.col("center_time_bottom"))


def assemble_pulses(df: DataFrame, pulse: Sequence[str], fragment: str = "record_i", data: str = "data") -> DataFrame:
    """(pulse, data): fragments put back together in order."""
    parts = F.sort_array(F.collect_list(F.struct(F.col(fragment).alias("i"), F.col(data).alias("d"))))
    return df.groupBy(*pulse).agg(F.flatten(F.transform(parts, lambda x: x["d"])).alias(data))


def polygon_area(points: Column) -> Column:
    """Shoelace area of a closed polygon given as array<array<double>> corners."""
    n = F.size(points)
    cross = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.get(F.get(points, i), F.lit(0)) * F.get(F.get(points, (i + 1) % n), F.lit(1)) - F.get(F.get(points, (i + 1) % n), F.lit(0)) * F.get(F.get(points, i), F.lit(1)),
    )
    return F.abs(F.aggregate(cross, F.lit(0.0), lambda a, x: a + x)) / 2


# --- numpy kernels -----------------------------------------------------------------------------------------------


def find_hits(data: np.ndarray, threshold: float) -> list[tuple[int, int, float, float, int]]:
    """(left, right, area, height, max_sample) of each run of samples at or above threshold; right is exclusive."""
    over = np.concatenate([[False], np.asarray(data) >= threshold, [False]])
    edges = np.flatnonzero(over[1:] != over[:-1])
    return [(int(a), int(b), float(data[a:b].sum()), float(data[a:b].max()), int(a + data[a:b].argmax())) for a, b in zip(edges[::2], edges[1::2])]


def process_pulse(raw: np.ndarray, baseline_samples: int = 40) -> tuple[np.ndarray, float, float]:
    """Baseline over the first samples; the pulse flipped around it; (data, baseline, rms)."""
    head = raw[:baseline_samples]
    baseline = float(head.mean()) if len(head) else 0.0
    return baseline - raw, baseline, float(np.sqrt(((head - baseline) ** 2).mean())) if len(head) else 0.0


def keep_around_hits(data: np.ndarray, hits, left: int = 3, right: int = 20) -> np.ndarray:
    """Samples outside the extended hits set to zero."""
    keep = np.zeros(len(data), dtype=bool)
    for h in hits:
        keep[max(h[0] - left, 0) : h[1] + right] = True
    return np.where(keep, data, 0)


def fir_filter(data: np.ndarray, kernel: Sequence[float]) -> np.ndarray:
    return np.convolve(data, kernel, mode="same")


def area_quantile_times(data: np.ndarray, fractions: Sequence[float], dt: float = 1.0) -> np.ndarray:
    """Times at which the cumulative area reaches the fractions, linear within a sample; zeros for an empty waveform."""
    area = float(np.sum(data))
    if area <= 0:
        return np.zeros(len(fractions))
    cumulative = np.concatenate([[0.0], np.cumsum(np.maximum(data, 0))])
    return np.interp(np.asarray(fractions) * cumulative[-1], cumulative, np.arange(len(data) + 1)) * dt


def widths(data: np.ndarray, dt: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """(width[11], area_decile_from_midpoint[11]): central ranges that hold k/10 of the area, deciles from the median."""
    q = area_quantile_times(data, np.linspace(0, 1, 21), dt)
    return q[10:] - q[10::-1], q[::2] - q[10]


def goodness_of_split(data: np.ndarray) -> np.ndarray:
    """Natural-breaks gain for a cut before each sample: 1 - (weighted variances of both sides) / variance."""
    t, w = np.arange(len(data)), np.maximum(np.asarray(data, dtype=float), 0)
    out = np.zeros(len(data))
    whole = w.sum()
    if whole <= 0:
        return out
    cw, ct, ctt = (np.concatenate([[0.0], np.cumsum(x)]) for x in (w, w * t, w * t * t))
    spread = lambda n, s, ss: np.where(n > 0, ss - s * s / np.where(n > 0, n, 1), 0.0)
    total_spread = float(spread(cw[-1], ct[-1], ctt[-1]))
    if total_spread <= 0:
        return out
    left = spread(cw, ct, ctt)
    right = spread(cw[-1] - cw, ct[-1] - ct, ctt[-1] - ctt)
    return np.clip(1 - (left + right)[:-1] / total_spread, 0, 1)


def natural_breaks(data: np.ndarray, threshold, min_area: float = 40.0, iterations: int = 20) -> list[tuple[int, int]]:
    """Pieces of a waveform, split where the gain is largest while it exceeds threshold(area, width)."""
    todo, done = [(0, len(data), 0)], []
    while todo:
        a, b, depth = todo.pop()
        part = np.asarray(data[a:b], dtype=float)
        gain = goodness_of_split(part)
        cut = int(gain.argmax()) if len(gain) else 0
        if depth < iterations and 0 < cut < b - a and part.sum() >= min_area and gain[cut] > threshold(part.sum(), b - a):
            todo += [(a + cut, b, depth + 1), (a, a + cut, depth + 1)]
        else:
            done.append((a, b))
    return sorted(done)


def local_minimum_split(data: np.ndarray, min_height: float, min_ratio: float) -> list[tuple[int, int]]:
    """Cuts at minima whose both neighbouring maxima rise by min_height and by the factor min_ratio."""
    data = np.asarray(data, dtype=float)
    cuts, start, top, low, low_at = [], 0, -np.inf, np.inf, 0
    for i, y in enumerate(data):
        if y > top and low == np.inf:
            top = y
        if y < low and y < top:
            low, low_at = y, i
        if low < np.inf and y > max(low + min_height, low * min_ratio):
            if top > max(low + min_height, low * min_ratio):
                cuts.append((start, low_at))
                start = low_at
            top, low = y, np.inf
    return [*cuts, (start, len(data))]


def smooth(data: np.ndarray, width: int, power: float = 3.0) -> np.ndarray:
    """Convolution with the normalised kernel (1 - |i / width|^power)^power for i from -width to width."""
    u = np.arange(-width, width + 1) / width
    kernel = (1 - np.abs(u) ** power) ** power
    return np.convolve(data, kernel / kernel.sum())[width : width + len(data)]


def local_extrema(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the maxima and minima: where a sample is larger than the one before it, and the next one is not; and the reverse. What
    comes before the first sample counts as zero."""
    rises = np.diff(np.asarray(data, dtype=float), prepend=0.0) > 0
    return np.flatnonzero(rises[:-1] & ~rises[1:]), np.flatnonzero(~rises[:-1] & rises[1:])


def above_share(data: np.ndarray, share: float) -> tuple[int, int]:
    """First and last (exclusive) sample of at least that share of the maximum."""
    at = np.flatnonzero(data >= data.max() * share)
    return int(at[0]), int(at[-1]) + 1


def valley(data: np.ndarray, tops: np.ndarray, lows: np.ndarray, share: float = 0.9) -> tuple[int, float]:
    """(gap, depth) of the deepest valley: the lower of its two maxima less its minimum, and the samples between the places where the
    waveform falls to that share of the depth above the minimum after the first maximum, and rises over it again after the minimum.
    Zeros unless every minimum lies between two maxima."""
    if not len(lows) or len(tops) != len(lows) + 1:
        return 0, 0.0
    data = np.asarray(data, dtype=float)
    depths = np.minimum(data[tops[:-1]], data[tops[1:]]) - data[lows]
    k = int(np.argmax(depths))
    level = data[lows[k]] + depths[k] * share
    below = np.flatnonzero(data[tops[k] :] <= level)
    above = np.flatnonzero(data[lows[k] :] > level)
    left = int(tops[k] + below[0]) if len(below) else 0
    right = int(lows[k] + above[0]) if len(above) else 0
    return right - left, float(depths[k])


def local_minimum_info(data: np.ndarray, dt: float = 1.0, divide: float = 7.0, power: float = 3.0, least: float = 0.1, share: float = 0.9) -> tuple[float, int, float, float]:
    """(largest goodness of split, number of maxima, valley gap, valley depth over the smoothed maximum) of a peak.

    It is smoothed over its 90 % width divided by ``divide``; extrema count where the smoothed peak has the least share of its maximum.
    """
    data = np.asarray(data, dtype=float)
    if data.sum() <= 0:
        return float("nan"), 0, float("nan"), float("nan")
    cover = int(np.ceil(widths(data)[0][9] / divide))
    smoothed = smooth(data, max(cover, 1), power)
    left, right = above_share(smoothed, least)
    tops, lows = (x[(x >= left) & (x < right)] for x in local_extrema(smoothed))
    gap, depth = valley(smoothed, tops, lows, share)
    return float(goodness_of_split(data[left:right]).max()), len(tops), gap * dt, depth / float(smoothed.max())


def split_threshold(rise_time: Column, area: Column, s1_curve, s2_curve) -> Column:
    """Threshold of the goodness of split: two curves over log10(area), mixed by how much the rise time (ns) looks like an S2's."""
    from chronofold.functions.numeric import piecewise_linear

    clip = lambda c, hi: F.least(F.greatest(c.cast("double"), F.lit(1.0)), F.lit(hi))
    share = 1 / (1 + F.exp(-8 * F.log10(clip(rise_time, 1e5) / 100)))
    size = F.log10(clip(area, 1e7))
    return share * piecewise_linear(size, *zip(*s2_curve)) + (1 - share) * piecewise_linear(size, *zip(*s1_curve))


def correct_saturation(data: np.ndarray, reference: np.ndarray, ceiling: float, before: int = 100, min_reference: float = 20.0) -> np.ndarray:
    """Samples from the first saturated one on, replaced by the reference waveform scaled to the unsaturated samples before it."""
    at = np.flatnonzero(np.asarray(data) >= ceiling)
    if not len(at):
        return np.asarray(data, dtype=float)
    first = int(at[0])
    start = max(first - before, 0)
    base = float(np.sum(reference[start:first]))
    out = np.asarray(data, dtype=float).copy()
    if base < min_reference:
        return out
    scale = float(np.sum(out[start:first])) / base
    if scale > 1:
        return out
    out[first:] = np.maximum(out[first:], np.asarray(reference[first:], dtype=float) * scale)
    return out


def find_afterpulses(hits: Sequence[tuple[int, int]], led: tuple[int, int], compat: bool = False) -> list[tuple[int, int, int]]:
    """(left, right, tdelay) of merged hits after the LED hit of a record; compat drops the last one."""
    merged: list[list[int]] = []
    for a, b in sorted(hits):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(b, merged[-1][1])
        else:
            merged.append([a, b])
    light = next((h for h in merged if h[0] < led[1] and h[1] > led[0]), None)
    if light is None:
        return []
    out = [(a, b, a - light[0]) for a, b in merged if a > light[0]]
    return out[:-1] if compat else out


# --- Arrow wrappers ----------------------------------------------------------------------------------------------

HIT = "array<struct<left:int,right:int,area:double,height:double,max_sample:int>>"


def with_arrays(df: DataFrame, key: Sequence[str], data: str, kernel, schema: str, more: Sequence[str] = ()) -> DataFrame:
    """(key, result): kernel(numpy samples, further columns...) -> value of the schema, in Arrow batches without a shuffle."""
    keys, others = list(key), list(more)

    def run(batches):
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in others]
            values = [kernel(np.asarray(x, dtype=float), *m) for x, *m in zip(batch.column(data).to_pylist(), *columns)]
            arrays = [batch.column(k) for k in keys]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(values, type=arrow_type)], names=[*keys, "result"])

    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string

    arrow_type = to_arrow_type(_parse_datatype_string(schema))
    fields = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)
    return df.select(*dict.fromkeys([*keys, data, *others])).mapInArrow(run, f"{fields}, result {schema}")


def hits_of(df: DataFrame, threshold: float, key: Sequence[str], data: str = "data") -> DataFrame:
    """One row per threshold hit of each waveform."""
    names = ("left", "right", "area", "height", "max_sample")
    found = with_arrays(df, key, data, lambda d: [dict(zip(names, h)) for h in find_hits(d, threshold)], HIT)
    return found.select(*key, F.explode("result").alias("h")).select(*key, "h.*")
