"""Special functions and interpolating maps (numpy on the inside, Arrow batches on the outside)."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def poisson_2nll(observed: np.ndarray, expected: np.ndarray) -> np.ndarray:
    """Modified Poisson -2 ln L per channel, less that of a perfect fit: 2 (mu - n + n ln(n / mu)); a channel that saw nothing, or of
    which nothing is expected, adds 0."""
    n, mu = np.asarray(observed, float), np.asarray(expected, float)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where((n > 0) & (mu > 0), 2 * (mu - n + n * np.log(n / mu)), 0.0)


def poisson_pmf(k: Column, mu: Column) -> Column:
    """exp(k ln mu - mu - ln k!) with the factorial from Stirling's series beyond 20."""
    small = F.ln(F.factorial(F.least(k, F.lit(20)).cast("int")).cast("double"))
    x = (k + 1).cast("double")
    stirling = (x - 0.5) * F.ln(x) - x + 0.5 * F.lit(math.log(2 * math.pi)) + 1 / (12 * x) - 1 / (360 * x * x * x)
    return F.exp(k * F.ln(mu) - mu - F.when(k <= 20, small).otherwise(stirling))


def piecewise_linear(x: Column, xs: Sequence[float], ys: Sequence[float]) -> Column:
    """Linear between the knots, flat beyond them."""
    out = F.when(x <= xs[0], F.lit(float(ys[0])))
    for (x0, y0), (x1, y1) in zip(zip(xs, ys), zip(xs[1:], ys[1:])):
        out = out.when(x <= x1, y0 + (x - x0) * ((y1 - y0) / (x1 - x0)))
    return out.otherwise(F.lit(float(ys[-1])))


class NearestMap:
    """Inverse-distance weighting over the 2 * dim nearest points; NaN in gives NaN out, no dimension gives a constant."""

    def __init__(self, points, values):
        self.points = np.asarray(points, float)
        self.values = np.asarray(values, float)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        x = np.atleast_2d(np.asarray(x, float))
        if self.points.size == 0:
            return np.repeat(np.atleast_1d(self.values)[None, ...], len(x), axis=0).squeeze(-1) if self.values.ndim < 2 else np.repeat(self.values, len(x), axis=0)
        k = min(2 * self.points.shape[1], len(self.points))
        out = np.full((len(x), *self.values.shape[1:]), np.nan)
        for at in range(0, len(x), 1024):
            part = x[at : at + 1024]
            ok = ~np.isnan(part).any(axis=1)
            d = np.sqrt(((part[ok][:, None, :] - self.points[None]) ** 2).sum(-1))
            near = np.argsort(d, axis=1, kind="stable")[:, :k]
            w = 1 / np.maximum(np.take_along_axis(d, near, 1), 1e-6)
            w /= w.sum(1, keepdims=True)
            v = self.values[near]
            res = out[at : at + 1024]
            res[ok] = (v * w.reshape(*w.shape, *[1] * (v.ndim - 2))).sum(1)
        return out


class GridMap:
    """Multilinear interpolation on a regular grid, extrapolating linearly beyond its edges."""

    def __init__(self, axes: Sequence[Sequence[float]], values):
        self.axes = [np.asarray(a, float) for a in axes]
        self.values = np.asarray(values, float)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        x = np.atleast_2d(np.asarray(x, float))
        low, frac = [], []
        for a, c in zip(self.axes, x.T):
            i = np.clip(np.searchsorted(a, c, side="right") - 1, 0, len(a) - 2)
            low.append(i)
            frac.append((c - a[i]) / (a[i + 1] - a[i]))
        out = 0.0
        for corner in range(1 << len(self.axes)):
            w, index = np.ones(len(x)), []
            for d in range(len(self.axes)):
                up = corner >> d & 1
                w = w * (frac[d] if up else 1 - frac[d])
                index.append(low[d] + up)
            v = self.values[tuple(index)]
            out = out + v * w.reshape(-1, *[1] * (v.ndim - 1))
        return out


def spline_knots(x: np.ndarray) -> np.ndarray:
    """Knots of the interpolating cubic spline: fourfold at the ends, and at all points but the first and last two."""
    return np.concatenate([[x[0]] * 4, x[2:-2], [x[-1]] * 4])


def spline_basis(knots: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, values): the four cubic B-splines that are not zero at each x, and the number of the first of them; x is clamped to the knots' range."""
    x = np.clip(x, knots[3], knots[-4])
    at = np.clip(np.searchsorted(knots, x, side="right") - 1, 3, len(knots) - 5)
    values = np.zeros((len(x), 4))
    values[:, 0] = 1.0
    for k in range(1, 4):
        carried = np.zeros(len(x))
        for j in range(k):
            right, left = knots[at + j + 1], knots[at + j + 1 - k]
            part = values[:, j] / (right - left)
            values[:, j] = carried + (right - x) * part
            carried = (x - left) * part
        values[:, k] = carried
    return at - 3, values


def solve_spline(x: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Coefficients of the splines through the rows of values at x: a banded elimination, without pivots, which collocation by B-splines never needs."""
    first, basis = spline_basis(spline_knots(x), x)
    n = len(x)
    band, right = np.zeros((n, 7)), np.array(values, dtype=float)
    for k in range(4):
        band[np.arange(n), np.clip(first + k - np.arange(n) + 3, 0, 6)] += basis[:, k]
    for i in range(n):
        for r in range(i + 1, min(i + 4, n)):
            factor = band[r, i - r + 3] / band[i, 3]
            if factor:
                band[r, i - r + 3 : i - r + 7] -= factor * band[i, 3:]
                right[r] -= factor * right[i]
    for i in reversed(range(n)):
        for k in range(1, min(4, n - i)):
            right[i] -= band[i, 3 + k] * right[i + k]
        right[i] /= band[i, 3]
    return right


class BicubicMap:
    """The bicubic spline through the values of a rectangular grid, clamped at its edges; at least four points along each axis. The coefficients are solved
    once, where the map is made; a batch only evaluates sixteen products a point."""

    def __init__(self, xs, ys, values):
        xs, ys = np.asarray(xs, float), np.asarray(ys, float)
        if min(len(xs), len(ys)) < 4:
            raise ValueError("a bicubic spline needs four points along each axis")
        self.kx, self.ky = spline_knots(xs), spline_knots(ys)
        self.coefficients = solve_spline(ys, solve_spline(xs, np.asarray(values, float)).T).T

    def __call__(self, x: np.ndarray) -> np.ndarray:
        x = np.atleast_2d(np.asarray(x, float))
        ok = ~np.isnan(x).any(axis=1)
        out = np.full(len(x), np.nan)
        (ix, wx), (iy, wy) = spline_basis(self.kx, x[ok, 0]), spline_basis(self.ky, x[ok, 1])
        cells = self.coefficients[ix[:, None, None] + np.arange(4)[:, None], iy[:, None, None] + np.arange(4)]
        out[ok] = np.einsum("ni,nij,nj->n", wx, cells, wy)
        return out


class RotatedLinearMap:
    """Linear along one axis of a frame turned by ``angle`` degrees, nearest row along the other, chosen for each point."""

    def __init__(self, along, across, values, angle: float = 0.0):
        self.along, self.across, self.values = np.asarray(along, float), np.asarray(across, float), np.asarray(values, float)
        self.turn = math.radians(angle)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        x = np.atleast_2d(np.asarray(x, float))
        u = x[:, 0] * math.cos(self.turn) - x[:, 1] * math.sin(self.turn)
        v = x[:, 0] * math.sin(self.turn) + x[:, 1] * math.cos(self.turn)
        row = np.abs(v[:, None] - self.across[None]).argmin(1)
        return np.array([np.interp(a, self.along, self.values[r]) for a, r in zip(u, row)])


def scaled(points: np.ndarray, factors: Sequence[float]) -> np.ndarray:
    """Coordinates of a map stretched per axis."""
    return np.asarray(points, float) * np.asarray(factors, float)


def quantize(values: np.ndarray, step: float) -> np.ndarray:
    """Map values as 16-bit multiples of step."""
    return np.round(np.asarray(values, float) / step).astype(np.int16)


def apply_map(df: DataFrame, f: Callable[[np.ndarray], np.ndarray], inputs: Sequence[str], out: str) -> DataFrame:
    """df with ``out`` = f(inputs); f's points travel in the closure, so they must be bounded (a calibration map)."""
    schema = df.schema

    def run(batches):
        for batch in batches:
            x = np.stack([batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in inputs], axis=1) if batch.num_rows else np.empty((0, len(inputs)))
            y = np.asarray(f(x), float).reshape(-1) if batch.num_rows else np.empty(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(y, pa.float64())], names=[*batch.schema.names, out])

    from pyspark.sql.types import DoubleType, StructType

    return df.mapInArrow(run, StructType([*schema.fields]).add(out, DoubleType()))


def nearest_reference(vector: Column, references: Sequence[Sequence[float]]) -> Column:
    """0-based index of the reference vector at the least Euclidean distance, the first on ties."""
    def distance(ref):
        return F.aggregate(F.zip_with(vector, F.array(*[F.lit(float(v)) for v in ref]), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)

    all_ = F.array(*[distance(r) for r in references])
    return (F.array_position(all_, F.array_min(all_)) - 1).cast("int")
