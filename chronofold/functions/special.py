"""Special functions over whole arrays, and as column functions in Arrow batches.

Root finding and continued fractions run for all rows at once; a mask says which rows go on, so a batch takes as many rounds as its hardest row.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import ArrowUDFType

#: Coefficients of Stirling's series of ln gamma and of its derivative (fixed values).
_STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188, -691 / 360360, 1 / 156)
_DIGAMMA = (-1 / 12, 1 / 120, -1 / 252, 1 / 240, -1 / 132, 691 / 32760, -1 / 12)
_SHIFT = 10


def lgamma(x) -> np.ndarray:
    """ln gamma of positive numbers: Stirling's series ten places up, less the product on the way there. NaN elsewhere, but infinite at 0."""
    x = np.asarray(x, dtype=float)
    with np.errstate(divide="ignore", invalid="ignore"):
        way = sum(np.log(x + k) for k in range(_SHIFT))
        z = x + _SHIFT
        series = sum(c / z ** (2 * k + 1) for k, c in enumerate(_STIRLING))
        out = (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + series - way
    return np.where(x < 0, np.nan, out)


def digamma(x) -> np.ndarray:
    """The derivative of ln gamma, for positive numbers."""
    x = np.asarray(x, dtype=float)
    z = x + _SHIFT
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.log(z) - 0.5 / z + sum(c / z ** (2 * k + 2) for k, c in enumerate(_DIGAMMA)) - sum(1 / (x + k) for k in range(_SHIFT))


def betainc(a, b, x, rounds: int = 500) -> np.ndarray:
    """Regularised incomplete beta function, by Lentz's continued fraction; NaN outside its domain."""
    shape = np.broadcast_shapes(np.shape(a), np.shape(b), np.shape(x))
    a, b, x = (np.array(v, dtype=float).ravel() for v in np.broadcast_arrays(a, b, x))
    good = (a > 0) & (b > 0) & (x >= 0) & (x <= 1)
    turned = good & (x > (a + 1) / (a + b + 2))
    a, b, x = np.where(turned, b, a), np.where(turned, a, b), np.where(turned, 1 - x, x)
    out = np.where(good, np.where(x <= 0, 0.0, 1.0), np.nan)
    todo = np.flatnonzero(good & (x > 0) & (x < 1))
    p, q, t = a[todo], b[todo], x[todo]
    front = np.exp(lgamma(p + q) - lgamma(p) - lgamma(q) + p * np.log(t) + q * np.log1p(-t)) / p
    f, c, d, live = np.ones(len(todo)), np.ones(len(todo)), np.zeros(len(todo)), np.ones(len(todo), dtype=bool)
    for i in range(rounds):
        m = i // 2
        if i == 0:
            num = np.ones(len(todo))
        elif i % 2 == 0:
            num = m * (q - m) * t / ((p + 2 * m - 1) * (p + 2 * m))
        else:
            num = -(p + m) * (p + q + m) * t / ((p + 2 * m) * (p + 2 * m + 1))
        nonzero = lambda v: np.where(v == 0, 1e-300, v)
        d = np.where(live, 1 / nonzero(1 + num * d), d)
        c = np.where(live, nonzero(1 + num / c), c)
        f = np.where(live, f * c * d, f)
        live &= np.abs(1 - c * d) >= 1e-14
        if not live.any():
            break
    out[todo] = front * (f - 1)
    return np.where(turned, 1 - out, out).reshape(shape)


def binom_logpmf(k, n, p) -> np.ndarray:
    """log of the binomial density for real k and n."""
    k, n, p = np.broadcast_arrays(*(np.asarray(v, dtype=float) for v in (k, n, p)))
    with np.errstate(divide="ignore", invalid="ignore"):
        return lgamma(n + 1) - lgamma(n - k + 1) - lgamma(k + 1) + k * np.log(p) + (n - k) * np.log1p(-p)


def binom_cdf(k, n, p) -> np.ndarray:
    k, n, p = np.broadcast_arrays(*(np.asarray(v, dtype=float) for v in (k, n, p)))
    inside = (k >= 0) & (k < n)
    return np.where(inside, betainc(np.where(inside, n - k, 1.0), np.where(inside, k + 1, 1.0), 1 - p), np.where(k >= n, 1.0, 0.0))


def secant(f: Callable[[np.ndarray, np.ndarray], np.ndarray], low, high, target, error: float = 1e-7, rounds: int = 50) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(last place, place before it, f at the one before those) of the search for f = target in each row's bounds.

    f(x, rows) gives the values of those rows. A row stops when its step is below error, or where f is flat, at the better of both places.
    """
    low, high, target = (np.array(v, dtype=float) for v in np.broadcast_arrays(low, high, target))
    x0, x1, y0 = low.copy(), high.copy(), np.full(len(low), np.nan)
    live = np.abs(x1 - x0) > error
    for _ in range(rounds):
        at = np.flatnonzero(live)
        if not len(at):
            break
        a, b, goal = x0[at], x1[at], target[at]
        ya, yb = f(a, at), f(b, at)
        y0[at] = ya
        flat = ~(np.abs(yb - ya) >= error)
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.clip((goal - ya) / (yb - ya) * (b - a) + a, low[at], high[at])
        x = np.where(flat, np.where(np.abs(ya - goal) < np.abs(yb - goal), a, b), step)
        x0[at], x1[at] = np.where(flat, x, b), x
        live[at] = ~flat & (np.abs(x - b) > error)
    return x1, x0, y0


def binom_mode(n, p) -> np.ndarray:
    """Where the density of real k is highest, in [0, n]."""
    n, p = (np.array(v, dtype=float) for v in np.broadcast_arrays(n, p))
    with np.errstate(divide="ignore", invalid="ignore"):
        odds = np.log(p) - np.log1p(-p)
    slope = lambda k, at: digamma(n[at] - k + 1) - digamma(k + 1) + odds[at]
    return secant(slope, np.zeros(len(n)), n, 0.0)[0]


def binom_inverse(low, high, target, n, p) -> np.ndarray:
    """Where the log density crosses target within bounds; NaN where it does not before 0 or n, or the bounds are one place."""
    n, p = (np.array(v, dtype=float) for v in np.broadcast_arrays(n, p))
    low, high, target = (np.array(v, dtype=float) for v in np.broadcast_arrays(low, high, target))
    x1, x0, y0 = secant(lambda k, at: binom_logpmf(k, n[at], p[at]), low, high, target)
    stuck = x0 == x1
    lost = (low == high) | (stuck & (x1 == 0) & (y0 > target)) | (stuck & (x1 == n) & (y0 < target))
    return np.where(lost, np.nan, x1)


def binom_test(k, n, p) -> np.ndarray:
    """Two-sided p-value of real k: the tails from k outward, and outward from the place beyond the mode that is as likely. Where there is no such place only
    k's own tail counts, with its own density if it is the upper one. 1 at the mode; NaN unless 0 < p < 1 and 0 <= k <= n."""
    k, n, p = (np.array(v, dtype=float) for v in np.broadcast_arrays(*np.atleast_1d(k, n, p)))
    good = (p > 0) & (p < 1) & (n > 0) & (k >= 0) & (k <= n)
    k, n, p = np.where(good, k, 0.0), np.where(good, n, 1.0), np.where(good, p, 0.5)
    mode, here = binom_mode(n, p), binom_logpmf(k, n, p)
    reach, below = 2 * np.abs(mode - k), k < mode
    other = binom_inverse(np.where(below, mode, np.maximum(mode - reach, 0)), np.where(below, np.minimum(mode + reach, n), mode), here, n, p)
    left, right = np.where(below, k, other), np.where(below, other, k)
    tails = np.where(np.isnan(left), 0.0, binom_cdf(np.nan_to_num(left), n, p)) + np.where(np.isnan(right), 0.0, 1 - binom_cdf(np.nan_to_num(right), n, p))
    tails = np.where(np.isnan(left) & ~np.isnan(right), tails + np.exp(here), tails)
    return np.where(good, np.where(k == mode, 1.0, tails), np.nan)


def aft_probability(p, area, aft, discrete: bool = False) -> np.ndarray:
    """Probability of an S1's area fraction top under the expected one: a two-sided binomial test, or the density; NaN if unphysical."""
    p, area, aft = (np.asarray(v, dtype=float) for v in (p, area, aft))
    top = area * aft
    good = (p >= 0) & (p <= 1) & (top >= 0) & (top <= area)
    with np.errstate(invalid="ignore"):
        return np.where(good, np.exp(binom_logpmf(top, area, p)) if discrete else binom_test(top, area, p), np.nan)


def column(function: Callable[..., np.ndarray], *columns: Column | str) -> Column:
    """One of these functions of columns; null where one of them is null."""

    def run(*arrays: pa.Array) -> pa.Array:
        values = [a.to_numpy(zero_copy_only=False).astype(float) for a in arrays]
        return pa.array(np.asarray(function(*values), dtype=float), pa.float64())

    cols = [F.col(c) if isinstance(c, str) else c for c in columns]
    missing = F.lit(False)
    for c in cols:
        missing = missing | c.isNull()
    return F.when(~missing, F.arrow_udf(run, "double", ArrowUDFType.SCALAR)(*[c.cast("double") for c in cols]))
