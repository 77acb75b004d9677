"""Contours: attached by role, corrected point by point, reduced to uncertainties."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronofold.operators import contours as ct

SQUARE = [[3.0, 4.0], [6.0, 8.0], [0.0, 5.0], [0.0, 0.0]]


def test_points_move_along_their_radius(spark):
    rows = [(0, SQUARE, 3.0, 4.0, -2.0), (1, None, 1.0, 0.0, -1.0), (2, SQUARE, 3.0, 4.0, None), (3, [[1.0], [2.0, 3.0]], 0.0, 0.0, -1.0), (4, [], 0.0, 2.0, 0.0), (5, [[1.0, 1.0], None], None, 1.0, 0.0), (6, SQUARE[:3], 0.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "i int, contour array<array<double>>, x double, y double, z double").repartition(2)
    change = lambda p: 0.1 * p[:, 2] * np.hypot(p[:, 0], p[:, 1])  # noqa: E731  a radius grows by a tenth of z
    got = {r.i: r for r in ct.correct_contours(df, change, ["i"]).collect()}
    for i, z in ((0, -2.0), (6, 1.0)):
        ring, n = rows[i][1], 1 + 0.1 * z
        assert [list(p) for p in got[i].contour_fdc] == [pytest.approx([a * n, b * n]) for a, b in ring]
        area = abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1]))) / 2
        assert got[i].contour_area_fdc == pytest.approx(area * n * n)
    assert got[0].x_fdc == pytest.approx(2.4) and got[1].x_fdc == pytest.approx(0.9) and got[3].x_fdc == 0.0
    assert [got[i].contour_fdc for i in (1, 2, 3, 4, 5)] == [None] * 5 and got[2].x_fdc is None and got[5].x_fdc is None
    assert ct.correct_contours(df.limit(0), change, ["i"]).count() == 0


def test_uncertainty_goes_round_the_circle(spark):
    ring = [[math.cos(a) * r, math.sin(a) * r] for a, r in ((3.0, 1.0), (3.3, 2.0), (-3.1, 1.5))]
    df = spark.createDataFrame([(ring, -1.0, 0.01)], "c array<array<double>>, x double, y double")
    r, theta = ct.contour_uncertainty(F.col("c"), F.col("x"), F.col("y"))
    got = df.select(r.alias("r"), theta.alias("t"), ct.scaled_contour(F.col("c"), F.lit(1.0), F.lit(4.0)).alias("s")).first()
    assert got.r == pytest.approx(0.5) and got.t == pytest.approx(0.15) and got.s[0][0] == pytest.approx(ring[0][0] * 1.25)


def test_contours_of_roles(spark):
    peaks = spark.createDataFrame([("0", 1, SQUARE, 1.0, 2.0), ("0", 2, None, 3.0, 4.0), ("1", 1, [], 5.0, 6.0)], "run_id string, hit_id long, contour array<array<double>>, x double, y double")
    events = spark.createDataFrame([("0", 0, 1, 2), ("0", 1, 2, None), ("1", 0, 1, 9)], "run_id string, event_number long, s2_hit_id long, alt_s2_hit_id long")
    got = {(r.run_id, r.event_number): r for r in ct.attach_contours(events, peaks).collect()}
    assert got["0", 0].s2_contour == SQUARE and got["0", 0].alt_s2_x == 3.0 and got["0", 1].alt_s2_contour is None and got["1", 0].s2_contour == [] and got["1", 0].alt_s2_x is None
