"""Kernels against golden values and brute force."""

import math

import numpy as np
import pytest

from chronofold.functions import numeric as nm
from chronofold.operators import inference, monitor
from chronofold.operators import waveform as wf
from pyspark.sql import functions as F


def test_nearest_map_golden():
    xy = [(0, 0, 0), (0, 0, -1), (1, 1, 1)]
    m = nm.NearestMap(xy, [1.0, 2.0, 3.0])
    assert m([[0, 0, 0]])[0] == pytest.approx(1.0, abs=1e-5)
    assert np.isnan(m([[np.nan, 0, 0]])[0])


def test_grid_map_is_linear_and_extrapolates():
    g = nm.GridMap([[0, 1, 2], [0, 2]], [[0, 2], [1, 3], [2, 4]])
    assert g([[0.5, 1.0], [3.0, 3.0]]) == pytest.approx([1.5, 6.0])


def test_bicubic_and_rotated_maps_hit_their_knots():
    b = nm.BicubicMap([0, 1, 2, 3], [0, 1, 2, 3], np.add.outer(np.arange(4.0), 10 * np.arange(4.0)))
    assert b([[1, 2], [1.5, 1.5]]) == pytest.approx([21, 16.5])
    r = nm.RotatedLinearMap([0, 1], [0, 1], [[0, 1], [5, 7]])
    assert r([[0.5, 0.1], [0.5, 0.9]]) == pytest.approx([0.5, 6.0])


def dense_spline(x, v, at):
    """The not-a-knot cubic spline by a dense solve for the polynomial of each interval; at is clamped."""
    n = len(x) - 1
    rows, right = [], []

    def row(parts):
        r = np.zeros(4 * n)
        for k, c in parts:
            r[4 * k : 4 * k + 4] += c
        return r

    powers = lambda t, d: np.array([0.0 if p < d else math.factorial(p) / math.factorial(p - d) * t ** (p - d) for p in range(4)])
    for k in range(n):
        h = x[k + 1] - x[k]
        rows += [row([(k, powers(0, 0))]), row([(k, powers(h, 0))])]
        right += [v[k], v[k + 1]]
        if k < n - 1:
            rows += [row([(k, powers(h, d)), (k + 1, -powers(0, d))]) for d in (1, 2)]
            right += [0, 0]
    for k in (0, n - 2):
        rows.append(row([(k, powers(0, 3)), (k + 1, -powers(0, 3))]))
        right.append(0)
    c = np.linalg.solve(np.array(rows), np.array(right, dtype=float)).reshape(n, 4)
    at = min(max(at, x[0]), x[-1])
    k = min(max(int(np.searchsorted(x, at, side="right")) - 1, 0), n - 1)
    return float(c[k] @ powers(at - x[k], 0))


def test_bicubic_spline_between_its_knots():
    rng = np.random.default_rng(6)
    for nx, ny in ((4, 5), (9, 4), (12, 17)):
        x, y = (np.cumsum(rng.uniform(0.2, 2, n)) for n in (nx, ny))
        z = rng.normal(size=(nx, ny))
        points = np.column_stack([rng.uniform(x[0] - 1, x[-1] + 1, 40), rng.uniform(y[0] - 1, y[-1] + 1, 40)])
        got = nm.BicubicMap(x, y, z)(points)
        want = [dense_spline(x, [dense_spline(y, z[i], b) for i in range(nx)], a) for a, b in points]
        assert got == pytest.approx(want, abs=1e-9)
        knots = np.array([(a, b) for a in x for b in y])
        assert nm.BicubicMap(x, y, z)(knots) == pytest.approx(z.ravel(), abs=1e-9)
    cubic = nm.BicubicMap(x, y, np.add.outer(x**3, y**2 * 2))(points[:1].clip([x[0], y[0]], [x[-1], y[-1]]))
    a, b = points[0].clip([x[0], y[0]], [x[-1], y[-1]])
    assert cubic[0] == pytest.approx(a**3 + 2 * b**2)
    assert np.isnan(nm.BicubicMap(x, y, z)([[np.nan, 1.0]])[0])
    with pytest.raises(ValueError, match="four points"):
        nm.BicubicMap(x[:3], y, z[:3])


def test_poisson_statistic_is_zero_at_the_truth():
    mu = np.array([1.0, 5.0, 0.0])
    assert nm.poisson_2nll(mu, mu).sum() == pytest.approx(0)
    assert nm.poisson_2nll([2.0], [0.0])[0] == 0


def test_hits_and_pulse():
    d = np.array([0, 1, 1, 0, 1])
    assert [h[:2] for h in wf.find_hits(d, 1)] == [(1, 3), (4, 5)]
    data, base, rms = wf.process_pulse(np.array([10.0] * 40 + [4.0]))
    assert (base, rms, data[-1]) == (10, 0, 6)


def test_widths_of_a_box():
    w, deciles = wf.widths(np.ones(100))
    assert w[5] == pytest.approx(50) and w[10] == pytest.approx(100) and deciles[5] == pytest.approx(0)
    assert not np.isnan(wf.widths(np.zeros(5))[0]).any()


def test_natural_breaks_split_two_boxes():
    d = np.array([1.0] * 20 + [0.0] * 60 + [1.0] * 20)
    parts = wf.natural_breaks(d, lambda area, n: 0.8, min_area=1)
    assert len(parts) == 2 and 20 <= parts[0][1] <= 80


def test_saturation_and_afterpulses():
    ref = np.array([1.0] * 50 + [2, 8, 9, 4, 1])
    data = np.minimum(ref * 0.5, 2.0)
    fixed = wf.correct_saturation(data, ref, 2.0)
    assert fixed[51] == pytest.approx(4.0)
    assert wf.find_afterpulses([(5, 8), (20, 22), (21, 25), (40, 41)], (0, 10)) == [(20, 25, 15), (40, 41, 35)]
    assert wf.find_afterpulses([(5, 8), (20, 22)], (0, 10), compat=True) == []


def test_wrong_area_raises(spark):
    df = spark.createDataFrame([([1.0, 2.0], 3.0)], "area_per_channel array<double>, area double")
    df = df.withColumn("area_per_channel", F.transform("area_per_channel", lambda x: x.cast("long")))
    assert wf.check_area(df).count() == 1
    with pytest.raises(Exception, match="differs"):
        wf.check_area(df.withColumn("area", F.col("area") * 2)).collect()


def test_polygon(spark):
    df = spark.createDataFrame([([[0.0, 0.0], [2.0, 0.0], [2.0, 3.0], [0.0, 3.0]],)], "p array<array<double>>")
    assert df.select(wf.polygon_area(F.col("p")).alias("a")).first().a == pytest.approx(6)


def test_inference_gates(spark):
    df = spark.createDataFrame([([1.0, 4.0], 50.0), ([0.0, 0.0], 50.0), ([1.0, 1.0], 1.0)], "area_per_channel array<double>, area double")
    out = inference.positions(df, lambda x: x[:, :2], batch=2).collect()
    assert (out[0].x, out[0].y) == (0.25, 1.0)
    assert math.isnan(out[1].x) and math.isnan(out[2].x)
    assert math.isnan(inference.positions(df, None).first().x)


def test_last_bin_is_closed(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (10.1,)], "x double")
    assert [r[0] for r in df.select(monitor.bin_of(F.col("x"), 0, 10, 5)).collect()] == [0, 4, None]
    assert [r[0] for r in df.select(monitor.half_open_bin(F.col("x"), 0, 10, 5)).collect()] == [0, -1, -1]
