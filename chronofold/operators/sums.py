"""Sum waveforms and areas per channel of peaks, and the saturation of their channels, from the records that lie in them.

Records meet the peaks by the bucketed overlap join and go by peak through the island executor: in a batch of whole peaks each sample has one
place in one long buffer, so sums over all its peaks are one weighted count. One row per peak comes out, not one per sample.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofold.operators.executor import floats, lists, map_islands
from chronofold.operators.intervals import RUN, overlap_join
from chronofold.operators.ordered import HOUR

#: Largest sample of a record (16 bits with sign).
TOP = 1 << 15


def _in_peaks(peaks: DataFrame, records: DataFrame, peak: str, key: str, carry: Sequence[str], by: Sequence[str], width: int) -> DataFrame:
    """Records with the peak that they overlap (``island``), its start and end, in the executor's order."""
    lean = peaks.select(*by, "time", "endtime", F.col(peak).alias("island"))
    met = overlap_join(records.select(*by, "time", "endtime", key, "channel", "dt", "data", *carry), lean, by, width)
    return met.withColumnRenamed("w_island", "island")


class _Aligned:
    """The samples of a batch of whole peaks, and their places in one buffer that holds the peaks one after the other."""

    def __init__(self, batch: pa.RecordBatch, starts: np.ndarray, dt: int):
        number = lambda c: batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
        begin, end, time = number("w_time") // dt, -(-number("w_endtime") // dt), number("time") // dt
        self.samples, offsets = lists(batch, "data")
        sizes = np.diff(offsets)
        self.peak_of_row = np.searchsorted(starts, np.arange(batch.num_rows), side="right") - 1
        self.length = (end - begin)[starts]
        self.base = np.concatenate([[0], np.cumsum(self.length)])
        self.row = np.repeat(np.arange(batch.num_rows), sizes)
        self.sample = np.arange(len(self.samples)) - offsets[self.row]
        local = time[self.row] + self.sample - begin[self.row]
        self.inside = (local >= 0) & (local < self.length[self.peak_of_row[self.row]])
        self.place = self.base[self.peak_of_row[self.row]] + local

    def summed(self, weights: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        use = self.inside & chosen
        return np.bincount(self.place[use], weights[use], int(self.base[-1]))


def downsampled(wave: np.ndarray, most: int) -> tuple[np.ndarray, int]:
    """(sums of neighbouring samples, how many): at most ``most`` of them."""
    factor = -(-len(wave) // most) if len(wave) else 1
    return np.add.reduceat(wave, np.arange(0, len(wave), factor)) if factor > 1 else wave, factor


def peak_waveforms(
    peaks: DataFrame, records: DataFrame, n_channels: int, n_top: int, dt: int, most: int = 200, gain: str = "gain", peak: str = "peaklet", key: str = "record_id",
    by: Sequence[str] = RUN, width: int = HOUR,
) -> DataFrame:
    """(by, peak, time, length, dt, area, data, data_top, area_per_channel, n_saturated): one row per peak that any record overlaps.

    Samples of dt ns times the gain of their channel are added up where they lie; a peak longer than ``most`` samples is summed over as many
    neighbours as it takes. records: time, endtime, channel, dt, data, gain and, to count saturated channels, ceiling (the raw sample
    that is full, null for none).
    """
    ceiling = records if "ceiling" in records.columns else records.withColumn("ceiling", F.lit(None).cast("double"))
    rows = _in_peaks(peaks, ceiling, peak, key, [gain, "ceiling"], by, width)

    def kernel(batch: pa.RecordBatch, starts: np.ndarray) -> pa.RecordBatch:
        a, n = _Aligned(batch, starts, dt), len(starts)
        channel = batch.column("channel").to_numpy(zero_copy_only=False).astype(np.int64)
        light = a.samples * floats(batch, gain)[a.row]
        known = (channel >= 0) & (channel < n_channels)
        total = a.summed(light, known[a.row])
        top = a.summed(light, (known & (channel < n_top))[a.row])
        use = a.inside & known[a.row]
        cell = a.peak_of_row * n_channels + np.where(known, channel, 0)
        per_channel = np.bincount(cell[a.row][use], light[use], n * n_channels).reshape(n, n_channels)
        full = a.inside & (a.samples >= floats(batch, "ceiling")[a.row])
        saturated = np.bincount(np.unique(cell[a.row][full & known[a.row]]) // n_channels, minlength=n)
        waves, tops, factors = [], [], []
        for k in range(n):
            own = slice(a.base[k], a.base[k + 1])
            wave, factor = downsampled(total[own], most)
            waves.append(wave)
            tops.append(downsampled(top[own], most)[0])
            factors.append(factor * dt)
        arrays = lambda rows: pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32), np.concatenate(rows) if rows else np.zeros(0))
        at = pa.array(starts)
        begin = batch.column("w_time").to_numpy(zero_copy_only=False)[starts] // dt * dt
        cols = [batch.column(c).take(at) for c in (*by, "island")]
        cols += [pa.array(begin, pa.int64()), pa.array([len(w) for w in waves], pa.int32()), pa.array(factors, pa.int64()), pa.array(per_channel.sum(1)), arrays(waves), arrays(tops), arrays(list(per_channel))]
        return pa.RecordBatch.from_arrays([*cols, pa.array(saturated, pa.int32())], names=[*by, peak, "time", "length", "dt", "area", "data", "data_top", "area_per_channel", "n_saturated"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    out = ", ".join(f"{c} {kinds[c]}" for c in by) + f", {peak} {kinds['island']}, time long, length int, dt long, area double, data array<double>, data_top array<double>, area_per_channel array<double>, n_saturated int"
    return map_islands(rows, kernel, out, ("channel", "time", key), by)


def _rescaled(pulse: np.ndarray, full: np.ndarray, model: np.ndarray, gain: float, reference: int, least: int) -> tuple[int, float] | None:
    """(first saturated sample, ADC per unit of the model), or None where there is too little before it to compare, or the model has less than the channel."""
    at = np.flatnonzero(full)
    if not len(at):
        return None
    before = slice(max(int(at[0]) - reference, 0), int(at[0]))
    own, other = pulse[before], model[before]
    if (own * gain > 1).sum() < least or (other > 1).sum() < least or own.sum() * gain / other.sum() > 1:
        return None
    return int(at[0]), float(own.sum() / other.sum())


def desaturated_records(
    peaks: DataFrame, records: DataFrame, dt: int, reference: int = 100, least: int = 20, gain: str = "gain", ceiling: str = "baseline", peak: str = "peaklet", key: str = "record_id",
    by: Sequence[str] = RUN, width: int = HOUR,
) -> DataFrame:
    """(by, key, data, area, shift): records of saturated channels inside peaks, rebuilt; other records are absent.

    A channel of a peak is saturated from its first sample at or above the ceiling of its records on. From there to the peak's end its samples become
    the sum over the unsaturated channels (in units of gain), scaled by what both have in up to ``reference`` samples before, if at least ``least`` of those
    are over 1 in both and the channel has less than the others together. A record that then exceeds 16 bits is shifted right by ``shift`` bits as a whole;
    area is the sum before that. Samples of other peaks in the same record are judged on the record as it was, and the largest shift counts.
    """
    rows = _in_peaks(peaks, records, peak, key, [gain, ceiling], by, width)

    def kernel(batch: pa.RecordBatch, starts: np.ndarray) -> pa.RecordBatch:
        a = _Aligned(batch, starts, dt)
        channel = batch.column("channel").to_numpy(zero_copy_only=False).astype(np.int64)
        gains, limits = floats(batch, gain), floats(batch, ceiling)
        _, group = np.unique(np.stack([a.peak_of_row, channel]), axis=1, return_inverse=True)
        group = group.reshape(-1)
        lowest = np.full(group.max() + 1, np.inf)
        np.minimum.at(lowest, group, np.floor(limits))
        over = a.inside & (a.samples >= lowest[group][a.row])
        saturated = np.isin(group, np.unique(group[a.row][over]))
        model = a.summed(a.samples * gains[a.row], ~saturated[a.row])
        found: list[tuple[int, int, list[float]]] = []
        for g in np.unique(group[saturated]):
            mine = np.flatnonzero(group == g)
            p = int(a.peak_of_row[mine[0]])
            use = a.inside & np.isin(a.row, mine)
            pulse = np.bincount(a.place[use] - a.base[p], a.samples[use], int(a.length[p]))
            scaled = _rescaled(pulse, pulse >= lowest[g], model[a.base[p] : a.base[p + 1]], float(gains[mine[0]]), reference, least)
            if scaled is None:
                continue
            first, scale = scaled
            late = use & (a.place - a.base[p] >= first)
            for r in mine:
                own = np.flatnonzero(late & (a.row == r))
                if len(own):
                    found.append((int(r), int(a.sample[own[0]]), (model[a.place[own]] * scale).tolist()))
        at = pa.array([f[0] for f in found], pa.int64())
        cols = [batch.column(c).take(at) for c in (*by, key, "data")]
        return pa.RecordBatch.from_arrays([*cols, pa.array([f[1] for f in found], pa.int32()), pa.array([f[2] for f in found], pa.list_(pa.float64()))], names=[*by, key, "data", "first", "values"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    out = ", ".join(f"{c} {kinds[c]}" for c in (*by, key, "data")) + ", first int, values array<double>"
    pieces = map_islands(rows, kernel, out, ("channel", "time", key), by)
    each = pieces.groupBy(*by, key).agg(F.first("data").alias("data"), F.collect_list(F.struct("first", "values")).alias("pieces"))

    # A piece's values take the places from first on; rebuilt samples are whole numbers.
    def laid(data, piece):
        inside = lambda i: (i >= piece["first"]) & (i < piece["first"] + F.size(piece["values"]))
        return F.transform(data, lambda v, i: F.when(inside(i), F.get(piece["values"], i - piece["first"]).cast("long")).otherwise(v))

    whole = F.aggregate("pieces", F.col("data").cast("array<long>"), laid)
    highest = F.array_max(F.transform("pieces", lambda p: F.array_max(p["values"])))
    shift = F.when(highest >= TOP, F.floor(F.log2(highest) - 14).cast("int")).otherwise(0)
    each = each.select(*by, key, whole.alias("data"), shift.alias("shift"))
    area = F.aggregate("data", F.lit(0).cast("long"), lambda s, v: s + v)
    each = each.withColumn("area", area)
    return each.select(*by, key, F.transform("data", lambda v: F.call_function("div", v - F.pmod(v, F.expr("shiftleft(1L, shift)")), F.expr("shiftleft(1L, shift)"))).alias("data"), "area", "shift")
