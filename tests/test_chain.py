"""Peaklets, selections and corrections that have no SQL twin, or cases that the twins do not reach."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronofold.functions import special
from chronofold.operators import corrections, peaklets, selections
from chronofold.operators import waveform as wf
from chronofold.sources import files


def hits(spark, rows):
    return spark.createDataFrame([("0", t, t + n, i, c, 1) for i, (t, n, c) in enumerate(rows)], "run_id string, time long, endtime long, hit_id long, channel long, area long")


def test_peaklets_end_at_their_longest_duration(spark):
    h = hits(spark, [(i * 10, 8, i % 3) for i in range(10)] + [(1000, 5, 1), (1003, 5, 2), (2000, 5, 1)])
    whole = peaklets.find_peaklets(h, 20, 1, 2, 2).collect()
    assert [(r.peaklet, r.time, r.endtime, r.n_hits) for r in sorted(whole, key=lambda r: r.time)] == [(0, -1, 100, 10), (1, 999, 1010, 2)]
    cut = sorted(peaklets.find_peaklets(h, 20, 1, 2, 1, max_duration=40).collect(), key=lambda r: r.time)
    assert all(r.endtime - r.time <= 40 for r in cut) and sum(r.n_hits for r in cut) == 13
    assert [(r.time, r.n_hits) for r in cut] == [(-1, 3), (29, 3), (59, 3), (89, 1), (999, 2), (1999, 1)]


def test_two_samples_make_one_peaklet_of_three_hits(spark):
    w = spark.createDataFrame([(0, [0, 1, 1, 0, 1]), (1, [0, 1, 0, 0, 0])], "channel long, data array<int>")
    found = wf.hits_of(w, 1, ["channel"]).select(F.lit("0").alias("run_id"), F.col("left").cast("long").alias("time"), F.col("right").cast("long").alias("endtime"), F.monotonically_increasing_id().alias("hit_id"), "channel", F.col("area").cast("long").alias("area"))
    assert [r.n_hits for r in peaklets.find_peaklets(found, 10, 0, 0, 1).collect()] == [3]


def test_veto_events_of_shared_hitlets(spark):
    h = hits(spark, [(0, 5, 0), (2, 5, 1), (11, 30, 2), (38, 5, 0), (39, 5, 1), (300, 5, 1)])
    got = [(r.event_number, r.time, r.endtime, r.n_hits) for r in peaklets.veto_events(h, 2, 10).collect()]
    # The long hitlet touches both coincidences, so they are one event.
    assert got == [(0, 0, 44, 5)]


def test_local_minimum_of_two_peaks():
    t = np.arange(200)
    two = lambda a, b, s: np.exp(-((t - a) ** 2) / (2 * s * s)) + np.exp(-((t - b) ** 2) / (2 * s * s))
    peaks = [two(75, 125, 15), two(75, 125, 20), two(50, 150, 20)]
    found = [wf.local_extrema(p) for p in peaks]
    assert [(len(a), len(b)) for a, b in found] == [(2, 1)] * 3 and found[0][1][0] == found[1][1][0] == 100
    valleys = [wf.valley(p, *e, 0.9) for p, e in zip(peaks, found)]
    assert valleys[1][0] < valleys[0][0] < valleys[2][0] and valleys[1][1] < valleys[0][1] < valleys[2][1]
    assert wf.smooth(peaks[0], 5).shape == (200,) and wf.smooth(np.ones(50), 4)[20] == pytest.approx(1)
    gos, n, gap, ratio = wf.local_minimum_info(peaks[2], dt=10)
    assert n == 2 and 0 < ratio < 1 and gap % 10 == 0 and 0 < gos <= 1
    assert np.isnan(wf.local_minimum_info(np.zeros(10))[0])


def test_overlap_is_cut_at_a_quiet_gap_or_by_force(spark):
    rows = lambda spans: spark.createDataFrame(spans, "time long, endtime long, channel int")
    pairs = lambda df: sorted((r.time, r.endtime, r.channel) for r in df.collect())
    kept, cut = files.split_overlap(rows([(0, 10, 1), (20, 30, 1)]), 0, 100, 40, 5, 799)
    assert cut == 60 and pairs(kept) == [(0, 10, 1), (20, 30, 1)]
    kept, cut = files.split_overlap(rows([(0, 10, 1), (12, 20, 1), (70, 95, 1)]), 0, 100, 40, 5, 799)
    assert cut == 20 and pairs(kept) == [(0, 10, 1), (12, 20, 1)]
    kept, _ = files.split_overlap(rows([(0, 10, 1), (12, 20, 1), (70, 95, 1)]), 0, 100, 40, 5, 799, part="pre")
    assert pairs(kept) == [(70, 95, 1)]
    dense = rows([(i * 10, i * 10 + 9, 1) for i in range(10)])
    kept, cut = files.split_overlap(dense, 0, 100, 40, 25, 799)
    assert cut == 60 and pairs(kept) == [(i * 10, i * 10 + 9, 1) for i in range(4)] + [(35, 60, 799)] + [(i * 10, i * 10 + 9, 1) for i in (4, 5)]
    kept, _ = files.split_overlap(dense, 0, 100, 40, 25, 799, part="pre")
    assert pairs(kept) == [(60, 100, 799)]


def test_selections(spark):
    df = spark.createDataFrame([("0", 1, 2, 3, [1.0])], "run_id string, time long, endtime long, channel long, data array<double>")
    assert selections.without_arrays(df).columns == ["run_id", "time", "endtime", "channel"]
    assert selections.pass_through(df, ["channel"]).columns == ["run_id", "time", "endtime", "channel"]
    placed = selections.with_default_position(df.withColumns({"x_mlp": F.lit(1), "y_mlp": F.lit(2)}), "mlp").first()
    assert (placed.x, placed.y) == (1, 2)
    assert selections.assert_channels(df, [3]).count() == 1
    with pytest.raises(Exception, match="channel not allowed"):
        selections.assert_channels(df, [4]).collect()
    with pytest.raises(ValueError, match="at most"):
        selections.check_exclusive(["corrected_areas", "event_positions"])
    selections.check_exclusive(["corrected_areas", "peaks"])
    assert selections.apply_function(df, lambda d, run, targets: d.withColumn("r", F.lit(run + targets[0])), "7", ["p"]).first().r == "7p"
    with pytest.raises(ValueError, match="two thresholds"):
        selections.channel_thresholds(spark, [(1, [1, 2]), (2, [2])])
    assert selections.child_options({"a": 1, "b": 2}, {"a_mv": 5, "c": 3}, {"a_mv": "a"}) == {"a": 5, "b": 2, "a_mv": 5, "c": 3}
    with pytest.raises(KeyError, match="no option"):
        selections.child_options({"a": 1}, {}, {"a_mv": "z"})
    with pytest.raises(ValueError, match="online versions"):
        selections.check_global_version({"gain": "x://y?version=ONLINE", "n": 3}, "v5")
    selections.check_global_version({"gain": "x://y?version=ONLINE"}, "ONLINE")
    assert selections.load_entry_points("chronofold.nothing") == []


def test_area_fraction_top_probability():
    got = special.aft_probability([0.3, 1.3, 0.5, 0.5], [10, 10, 100, 100], [1.2, 0.2, 0.5, 0.9])
    assert (got != got).tolist() == [True, True, False, False] and 0.9 < got[2] < 1 + 1e-6 and got[3] < 1e-6
    assert special.aft_probability([0.5], [2], [0.5], discrete=True)[0] == pytest.approx(0.5)


def test_names_of_corrected_areas():
    assert corrections.cs2_name("111111") == "cs2" and corrections.cs2_name("011101") == "cs2_w_xy_segee_pi_elife"
    assert len({corrections.cs2_name(v) for v in corrections.CS2_VARIANTS}) == 15


def test_an_event_without_drift_time_keeps_its_fraction(spark):
    df = spark.range(1).select(F.lit(10.0).alias("a"), F.lit(0.6).alias("f"), F.lit(None).cast("double").alias("d"))
    one = F.lit(1.0)
    factors = {"bias": one, "xy_top": one, "xy_bottom": one, "segee": one, "pi": F.lit(2.0), "relcy": one, "elife": F.exp(F.col("d"))}
    row = df.select(*[c.alias(n) for n, c in corrections.corrected_s2(F.col("a"), F.col("f"), factors).items()]).first()
    assert row.cs2 is None and row.cs2_area_fraction_top == pytest.approx(6 / (6 + 8)) and row.cs2_w_bias == pytest.approx(10)
