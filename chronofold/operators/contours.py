"""Contours of reconstructed positions: attached to events, corrected for field distortion, and reduced to uncertainties.

A contour is a closed ring, array<array<double>> of (x, y). Correction moves every point along its radius by what a 3-D map gives at (x, y, z): the points of
all rings of a batch are one flat array, looked up at once, and folded back into rings.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofold.operators.events import attach_by_role
from chronofold.operators.executor import floats
from chronofold.operators.intervals import RUN

CONTOUR = "array<array<double>>"


def attach_contours(events: DataFrame, peaks: DataFrame, contour: str = "contour", roles: Sequence[str] = ("s2", "alt_s2"), key: str = "hit_id", by: Sequence[str] = RUN) -> DataFrame:
    """events with <role>_<contour>, <role>_x and <role>_y of the roles' peaks; null where a role is empty."""
    return attach_by_role(events, peaks, [contour, "x", "y"], key, roles, by)


def _rings(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(points, row of each, whether a row has a ring of points of two numbers)."""
    c = batch.column(column)
    sizes = pc.fill_null(pc.list_value_length(c), 0).to_numpy(zero_copy_only=False)
    inner = c.flatten()
    whole = pc.fill_null(pc.equal(pc.list_value_length(inner), 2), False).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(batch.num_rows), sizes)
    good = np.bincount(row[~whole], minlength=batch.num_rows) == 0 if len(row) else np.ones(batch.num_rows, dtype=bool)
    good &= sizes > 0
    kept = inner.filter(pa.array(whole & good[row])) if len(row) else inner
    points = kept.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, 2)
    return points, row[whole & good[row]] if len(row) else row, good


def correct_contours(
    df: DataFrame, change: Callable[[np.ndarray], np.ndarray], key: Sequence[str], contour: str = "contour", x: str = "x", y: str = "y", z: str = "z", prefix: str = ""
) -> DataFrame:
    """(key, contour_fdc, contour_area_fdc, x_fdc, y_fdc): ring and place with every point's radius changed by change(points (x, y, z)), and the area of the ring.

    A point in the middle has no direction and stays. Null rings, rings with a point that is not two numbers, and rows without z give nulls.
    """

    def moved(points: np.ndarray, depth: np.ndarray) -> np.ndarray:
        radius = np.hypot(points[:, 0], points[:, 1])
        with np.errstate(divide="ignore", invalid="ignore"):
            scale = np.where(radius > 0, change(np.column_stack([points, depth])).reshape(-1) / radius + 1, 1.0)
        return points * scale[:, None]

    def run(batches):
        for batch in batches:
            points, row, good = _rings(batch, contour)
            depth = floats(batch, z)
            good &= ~np.isnan(depth)
            use = good[row]
            points, row = moved(points[use], depth[row[use]]), row[use]
            place = moved(np.column_stack([floats(batch, x), floats(batch, y)]), depth)
            following = np.roll(np.arange(len(row)), -1)
            first = np.flatnonzero(np.diff(row, prepend=-1) != 0)
            last = np.append(first[1:], len(row)) - 1
            following[last] = first
            cross = points[:, 0] * points[following, 1] - points[following, 0] * points[:, 1]
            area = np.abs(np.bincount(row, cross, batch.num_rows)) / 2
            sizes = np.bincount(row, minlength=batch.num_rows)
            inner = pa.ListArray.from_arrays(pa.array(np.arange(0, 2 * len(row) + 1, 2, dtype=np.int32)), pa.array(points.reshape(-1)))
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            rings = pa.ListArray.from_arrays(pa.array(offsets), inner)
            rings = pc.if_else(pa.array(good), rings, pa.nulls(batch.num_rows, rings.type))
            off = np.isnan(place).any(axis=1)
            cols = [rings, pa.array(area, mask=~good), pa.array(place[:, 0], mask=off), pa.array(place[:, 1], mask=off)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in key), *cols], names=[*key, *names])

    names = [f"{prefix}{n}" for n in ("contour_fdc", "contour_area_fdc", "x_fdc", "y_fdc")]
    fields = ", ".join([*(f"{c} {df.schema[c].dataType.simpleString()}" for c in key), f"{names[0]} {CONTOUR}", *(f"{n} double" for n in names[1:])])
    return df.select(*dict.fromkeys([*key, contour, x, y, z])).mapInArrow(run, fields)


def scaled_contour(contour: Column, correction: Column, r_naive: Column) -> Column:
    """The ring scaled as its event's place is: by correction / r_naive + 1, without a map."""
    scale = F.try_divide(correction, r_naive) + 1
    return F.transform(contour, lambda p: F.transform(p, lambda v: v * scale))


def contour_uncertainty(contour: Column, x: Column, y: Column) -> tuple[Column, Column]:
    """(r_uncertainty, theta_uncertainty): half the range of the ring's radius, and half the range of its angle around the direction of (x, y)."""
    px, py = (lambda p: F.get(p, F.lit(0))), (lambda p: F.get(p, F.lit(1)))
    r = F.transform(contour, lambda p: F.hypot(px(p), py(p)))
    middle = F.atan2(y, x)
    off = F.transform(contour, lambda p: F.pmod(F.atan2(py(p), px(p)) - middle + F.pi(), 2 * F.pi()) - F.pi())
    return (F.array_max(r) - F.array_min(r)) / 2, (F.array_max(off) - F.array_min(off)) / 2
