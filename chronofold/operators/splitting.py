"""Recursive splitting of peaklet waveforms by natural breaks, and what a piece looks like.

A waveform is cut where the goodness of split is largest, as long as it exceeds a threshold that depends on the piece's own area and rise
time; both halves are judged anew, so the cuts form a tree. Its leaves become peaklets of their own, to which hits are dealt again by
containment. The tree of a peaklet is grown in its row's Arrow batch: splitting needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofold.operators import waveform as wf
from chronofold.operators.executor import lists
from chronofold.operators.intervals import RUN, split_by_containment
from chronofold.operators.merging import on_curve
from chronofold.operators.ordered import HOUR


@dataclass(frozen=True)
class SplitRules:
    """s1, s2: points (log10 area, threshold) for rise times like an S1's and an S2's (example values); wing: ns to both sides over which the waveform is smoothed
    before its height counts against a cut; least_area: smaller pieces stay whole; depth: most cuts above one piece."""

    s1: Sequence = ((0.5, 1.0), (3.5, 1.0), (4.0, 0.8))
    s2: Sequence = ((1.5, 0.6), (4.5, 0.4))
    wing: int = 70
    least_area: float = 40.0
    depth: int = 20
    prefer_low: bool = True


def threshold(area: float, rise_time: float, rules: SplitRules) -> float:
    """Two curves over log10 of the area, mixed by how much the rise time looks like an S2's."""
    share = 1 / (1 + np.exp(-8 * np.log10(min(max(rise_time, 1.0), 1e5) / 100)))
    size = float(np.log10(min(max(area, 1.0), 1e7)))
    return float(share * on_curve(size, rules.s2) + (1 - share) * on_curve(size, rules.s1))


def moving_average(data: np.ndarray, wing: int) -> np.ndarray:
    """Mean over up to wing samples on both sides; fewer at the ends."""
    sums = np.concatenate([[0.0], np.cumsum(data)])
    at = np.arange(len(data))
    lo, hi = np.maximum(at - wing, 0), np.minimum(at + wing + 1, len(data))
    return (sums[hi] - sums[lo]) / (hi - lo)


def best_cut(data: np.ndarray, dt: float, rules: SplitRules) -> tuple[int, float]:
    """(sample before which to cut, goodness of split there); a cut in a high place counts less."""
    gain = wf.goodness_of_split(data)
    if rules.prefer_low and len(data):
        height = moving_average(np.maximum(data, 0.0), int(rules.wing // dt))
        if height.max() > 0:
            gain = gain * (1 - height / height.max())
    cut = int(gain.argmax()) if len(gain) else 0
    return cut, float(gain[cut]) if len(gain) else 0.0


def split_tree(data: np.ndarray, dt: float, rules: SplitRules) -> list[tuple[int, int, int]]:
    """(first sample, end, depth) of the leaves in order."""
    todo, leaves = [(0, len(data), 0)], []
    while todo:
        a, b, depth = todo.pop()
        part = data[a:b]
        area = float(part.sum())
        cut, gain = best_cut(part, dt, rules) if area >= rules.least_area and depth < rules.depth else (0, 0.0)
        if 0 < cut < b - a and gain > threshold(area, float(-wf.widths(part, dt)[1][1]), rules):
            todo += [(a + cut, b, depth + 1), (a, a + cut, depth + 1)]
        else:
            leaves.append((a, b, depth))
    return leaves


def width_at(data: np.ndarray, dt: float, share: float = 0.5) -> float:
    """Width at that share of the maximum, linear between the middles of samples; NaN without a positive one."""
    if not len(data) or data.max() <= 0:
        return float("nan")
    level, at = share * data.max(), np.flatnonzero(data >= share * data.max())
    a, b = int(at[0]), int(at[-1])
    left = a - (data[a] - level) / (data[a] - (data[a - 1] if a else 0.0))
    after = data[b + 1] if b + 1 < len(data) else 0.0
    right = b + (data[b] - level) / (data[b] - after)
    return float((right - left) * dt)


_PIECE = "piece int, time long, endtime long, area double, depth int, rise_time double, range_50p_area double, range_90p_area double, width_half double, goodness double, n_maxima int, valley_gap double, valley double, data array<double>"


def split_peaklets(peaklets: DataFrame, rules: SplitRules | None = None, key: str = "peaklet", by: Sequence[str] = RUN) -> DataFrame:
    """(by, key, piece, time, endtime, area, depth, widths, data): the leaves of each peaklet's tree, numbered in time; a peaklet that is not
    split is one piece.

    peaklets: time, dt, data. With the widths come the half-maximum width and the local minima: the best goodness of split, the number of maxima of
    the smoothed piece, the width and relative depth of its deepest valley.
    """
    rules = rules or SplitRules()

    def run(batches):
        for batch in batches:
            values, offsets = lists(batch, "data")
            times, steps = batch.column("time").to_pylist(), batch.column("dt").to_pylist()
            parent, out = [], []
            for i in range(batch.num_rows):
                wave, dt = values[offsets[i] : offsets[i + 1]], steps[i]
                for n, (a, b, depth) in enumerate(split_tree(wave, dt, rules) if len(wave) else []):
                    part = wave[a:b]
                    width, deciles = wf.widths(part, dt)
                    gof, maxima, gap, deep = wf.local_minimum_info(part, dt)
                    parent.append(i)
                    out.append((n, times[i] + a * dt, times[i] + b * dt, float(part.sum()), depth, float(-deciles[1]), float(width[5]), float(width[9]), width_at(part, dt), gof, maxima, gap, deep, part.tolist()))
            at = pa.array(parent, pa.int64())
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.int32(), *[pa.float64()] * 5, pa.int32(), *[pa.float64()] * 2, pa.list_(pa.float64())]
            cols = [pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(at) for c in (*by, key)), *cols], names=[*by, key, *[f.split()[0] for f in _PIECE.split(", ")]])

    fields = ", ".join(f"{c} {peaklets.schema[c].dataType.simpleString()}" for c in (*by, key))
    return peaklets.select(*by, key, "time", "dt", "data").mapInArrow(run, f"{fields}, {_PIECE}")


def hits_of_pieces(pieces: DataFrame, hits: DataFrame, key: str = "peaklet", hit: str = "hit_id", by: Sequence[str] = RUN, width: int = HOUR) -> DataFrame:
    """hits with ``peaklet`` and ``piece``: those whose maximum (max_time) lies in a piece, however far they reach beyond it. Peaklets must be disjoint."""
    spans = pieces.select(*by, "time", "endtime", F.struct(key, "piece").alias("_piece"))
    points = hits.select(*by, hit, F.col("max_time").alias("time"), (F.col("max_time") + 1).alias("endtime"), F.struct(*hits.columns).alias("_hit"))
    held = split_by_containment(points, spans, "_piece", by, width)
    return held.select("_hit.*", F.col(f"_piece.{key}").alias(key), F.col("_piece.piece").alias("piece"))
