"""Registered queries on tables that reach beyond the ranges of the smallest ones."""

import datetime

import pytest

from chronofold.plans import registry

registry.load()


@pytest.fixture
def events(spark, tmp_path):
    def write(rows):
        """rows: (event_id, seconds, event_type, user_id, k)."""
        start = datetime.datetime(2024, 1, 2)
        full = [(i, start + datetime.timedelta(seconds=s), kind, user, 1.5, f'{{"k": {k}}}') for i, s, kind, user, k in rows]
        spark.createDataFrame(full, "event_id long, ts timestamp, event_type string, user_id long, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
        return str(tmp_path)

    return write


def test_dark_rate_has_every_channel(spark, events):
    path = events([(1, 0, "error", 5, 1), (2, 1, "error", 160, 1), (3, 2, "error", 4000, 1), (4, 3, "error", 4000, 1), (5, 4, "error", None, 1)])
    rows = registry.QUERIES["dark_rate"](spark, path).collect()
    assert sorted(r.channel for r in rows) == [*range(161), 4000]
    assert {r.channel: r.mean for r in rows if r.mean is not None} == {5: 150, 160: 150, 4000: 150}
    assert {r.channel: r.dark_rate for r in rows}[4000] == round(2 / 2592000, 9)


def test_clock_goes_on_beyond_the_first_and_last_sync(spark):
    from chronofold.operators import slow_control

    syncs = spark.createDataFrame([("0", 100, 1100), ("0", 200, 1210), ("0", 300, 1310), ("1", 50, 60), ("1", 50, 60), ("2", 10, 20), ("2", 30, 60)], "run_id string, time long, truth long")
    times = [("0", 0, 0), ("0", 99, 1), ("0", 100, 2), ("0", 150, 3), ("0", 300, 4), ("0", 301, 5), ("0", 1000, 6), ("1", 40, 7), ("1", 50, 8), ("2", 40, 9), ("3", 5, 10)]
    pulses = spark.createDataFrame(times, "run_id string, time long, hit_id long")
    for width in (7, 10**12):
        got = {r.hit_id: r.synced for r in slow_control.interpolate_clock(pulses, syncs, "hit_id", width=width).collect()}
        assert got == {0: 990, 1: 1099, 2: 1100, 3: 1155, 4: 1310, 5: 1311, 6: 2010, 7: None, 8: 60, 9: 80, 10: None}


def test_gps_extrapolate_leaves_no_pulse_without_a_time(spark, events):
    path = events([(3, 0, "signup", 1, 0), (6, 10, "error", 1, 0), (9, 15, "signup", 1, 0), (12, 20, "error", 1, 10), (15, 40, "signup", 1, 0)])
    start = 1_704_153_600 * 10**9
    got = {r.hit_id: r.synced - start - 5000 for r in registry.QUERIES["gps_extrapolate"](spark, path).collect()}
    assert got == {1: -10, 3: 15 * 10**9 + 5, 5: 40 * 10**9 + 30}
