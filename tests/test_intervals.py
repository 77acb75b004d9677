"""Golden and brute-force tests of the interval algebra; bucket widths never change a result."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from chronofold.operators import intervals as iv
from chronofold.operators import ordered

RUN = "0"


def frame(spark, rows, names="time long, endtime long, hit_id long"):
    cols = [c.split()[0] for c in names.split(",")]
    return spark.createDataFrame([(RUN, *r) for r in rows], "run_id string, " + names).select("run_id", *[c.strip() for c in cols])


def pairs(df):
    return sorted((r["time"], r["endtime"]) for r in df.collect())


@pytest.mark.parametrize("width", [5, 1000])
def test_merge_golden(spark, width):
    df = frame(spark, [(2, 4, 1), (3, 7, 2), (7, 8, 3), (20, 22, 4)])
    assert pairs(iv.merge_intervals(df, width=width)) == [(2, 8), (20, 22)]


@pytest.mark.parametrize("width", [10, 1000])
@pytest.mark.parametrize(("n", "pre", "expected"), [
    (1, 0, [(3, 31), (38, 48)]), (2, 0, [(3, 28)]), (3, 0, [(3, 25)]), (4, 0, [(3, 22)]), (5, 0, []),
    (1, 2, [(1, 31), (36, 48)]), (2, 2, [(1, 28)]), (3, 2, [(1, 25)]), (4, 2, [(1, 22)]),
])
def test_coincidence_golden(spark, n, pre, expected, width):
    times, ends = [3, 6, 9, 12, 15, 18, 21, 38], [5, 8, 10, 13, 16, 19, 23, 42]
    df = frame(spark, [(t, e, i) for i, (t, e) in enumerate(zip(times, ends))])
    assert pairs(iv.coincidence(df, n, 10, pre, width=width)) == expected


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10**6), st.sampled_from([3, 17, 200]))
def test_joins_match_brute_force(spark, seed, width):
    rng = random.Random(seed)
    span = lambda i: (t := rng.randint(-30, 60), t + rng.randint(1, 20), i)
    things, windows = [span(i) for i in range(12)], [span(i) for i in range(6)]
    a, b = frame(spark, things), frame(spark, windows, "time long, endtime long, w long")
    got = {(r.hit_id, r.w_w) for r in iv.overlap_join(a, b, width=width).collect()}
    assert got == {(x[2], y[2]) for x in things for y in windows if x[0] < y[1] and y[0] < x[1]}
    inside = {(r.hit_id, r.w_w) for r in iv.overlap_join(a, b, width=width, how="contained").collect()}
    assert inside == {(x[2], y[2]) for x in things for y in windows if x[0] >= y[0] and x[1] <= y[1]}
    lone = {r.hit_id for r in iv.outside(a, b, "hit_id", width=width).collect()}
    assert lone == {x[2] for x in things if not any(x[0] >= y[0] and x[1] <= y[1] for y in windows)}


@pytest.mark.parametrize("width", [4, 1000])
def test_nearest_is_strict_and_bounded(spark, width):
    left = frame(spark, [(10, 11, 1), (20, 21, 2), (90, 91, 3)])
    right = frame(spark, [(10, 11, 7), (18, 19, 8), (18, 19, 9), (95, 96, 10)])
    right = right.withColumn("id", right.hit_id)
    before = {r.hit_id: r.n_id for r in iv.nearest(left, right, ["id"], 50, "before", width=width).collect()}
    assert before == {1: None, 2: 9, 3: None}
    loose = {r.hit_id: r.n_id for r in iv.nearest(left, right, ["id"], 50, "before", False, width=width).collect()}
    assert loose == {1: 7, 2: 9, 3: None}
    after = {r.hit_id: r.n_id for r in iv.nearest(left, right, ["id"], 50, "after", width=width).collect()}
    assert after == {1: 8, 2: None, 3: 10}


def test_complement_has_no_overlap(spark):
    df = iv.merge_intervals(frame(spark, [(2, 4, 1), (3, 7, 2), (9, 12, 3)]), width=3)
    assert pairs(iv.complement(df, 0, 20, width=3)) == [(0, 2), (7, 9), (12, 20)]


def test_starts_and_stops(spark):
    one = lambda rows: frame(spark, [(t, t + 1, i) for i, t in enumerate(rows)])
    out = iv.pair_starts_stops(one([20, 40, 90]), one([5, 30, 45]), 0, 100, width=7, name="busy_", artificial=one([50]))
    assert pairs(out) == [(0, 5), (20, 30), (40, 45), (50, 51), (90, 100)]
    assert {(r.time, r.veto_type, r.veto_interval) for r in out.collect()} >= {(50, "artificial_deadtime_veto", 1), (90, "busy_veto", 10)}
    assert pairs(iv.pair_starts_stops(one([]), one([5]), 0, 100)) == [(0, 5)] and pairs(iv.pair_starts_stops(one([5]), one([]), 0, 100)) == [(5, 100)]
    with pytest.raises(Exception, match="unequal numbers"):
        iv.pair_starts_stops(one([10]), one([20, 30, 40]), 0, 100).collect()
    with pytest.raises(Exception, match="starts after its stop"):
        iv.pair_starts_stops(one([10, 20, 40, 90]), one([5, 30, 45]), 0, 100).collect()


def test_runs_never_meet(spark):
    """Two runs whose numbers and times are the same."""
    two = lambda rows, names: spark.createDataFrame([(r, *x) for r in "ab" for x in rows[r]], f"run_id string, {names}")
    windows = two({"a": [(0, 100, 0)], "b": [(0, 100, 0)]}, "time long, endtime long, event_number long")
    spans = two({"a": [(10, 20, 1)], "b": [(30, 50, 1)]}, "time long, endtime long, hit_id long")
    assert {(r.run_id, r.overlap) for r in iv.overlap_duration(windows, spans, "event_number").collect()} == {("a", 10), ("b", 20)}
    right = two({"a": [(5, 6, 1)], "b": [(7, 8, 1)]}, "time long, endtime long, hit_id long")
    got = iv.nearest(spans, right.withColumn("id", right.time), ["id"], None, "before").collect()
    assert {(r.run_id, r.n_id) for r in got} == {("a", 5), ("b", 7)} and len(got) == 2
    assert {(r.run_id, r.to_previous, r.to_next) for r in iv.distance_to_neighbours(right, spans, "hit_id").collect()} == {("a", None, 4), ("b", None, 22)}
    inside = two({"a": [(10, 20, 1)], "b": [(300, 400, 1)]}, "time long, endtime long, hit_id long")
    assert {(r.run_id, r.event_number) for r in iv.containing(inside, windows, "event_number", "hit_id").collect()} == {("a", 0), ("b", None)}
    assert [r.run_id for r in iv.outside(inside, windows, "hit_id").collect()] == ["b"]
    from chronofold.operators import monitor, neighbourhood

    hits = two({"a": [(0, 5, 1, 7, 0), (10, 5, 2, 8, 0)], "b": [(0, 1, 1, 7, 0)]}, "time long, area long, hit_id long, channel long, event_number long")
    assert {(r.run_id, r.area, r.n_hits, r.max_gap) for r in monitor.veto_event_properties(hits).collect()} == {("a", 10, 2, 10), ("b", 1, 1, None)}
    peaks = hits.selectExpr("*", "time + 1 as endtime", "time as center_time", "2 as type")
    assert {(r.run_id, r.hit_id, r.n_competing) for r in neighbourhood.competing(peaks, 100).collect()} == {("a", 1, 2), ("a", 2, 2), ("b", 1, 1)}


def test_a_run_long_interval_costs_few_copies(spark):
    """A day at a bucket width of a microsecond, beside short rows: all pairs, and no row is copied more than a few times."""
    day = 86_400 * 10**9
    things = frame(spark, [(i * 10**6, i * 10**6 + 10, i) for i in range(50)] + [(0, day, 99)])
    windows = frame(spark, [(0, day, 1), (5 * 10**6, 5 * 10**6 + 3, 2), (10, 10**9, 3)], "time long, endtime long, w long")
    got = {(r.hit_id, r.w_w) for r in iv.overlap_join(things, windows, width=1000).collect()}
    rows = lambda df: [(r[1], r[2], r[3]) for r in df.collect()]
    assert got == {(x[2], y[2]) for x in rows(things) for y in rows(windows) if x[0] < y[1] and y[0] < x[1]}
    assert {r.hit_id for r in iv.overlap_join(things, windows, width=1000, how="contained").where("w_w = 1").collect()} == {*range(50), 99}
    assert iv._spread(things, "time", "endtime", 1000).count() <= 5 * 51


def test_router_rejects_unknown_channels(spark):
    df = frame(spark, [(1, 2, 5)], "time long, endtime long, channel long")
    assert iv.route_channels(df, {"a": (0, 9)}).first().detector == "a"
    with pytest.raises(Exception, match="no detector"):
        iv.route_channels(df, {"a": (0, 3)}).collect()


@pytest.mark.parametrize("width", [2, 50])
def test_ordered_equals_one_window(spark, width):
    rng = random.Random(5)
    rows = [(rng.randint(-20, 40), 0, i) for i in range(30)]
    df = frame(spark, rows)
    order = sorted(rows, key=lambda r: (r[0], r[2]))
    got = {r.hit_id: r.n for r in ordered.row_numbers(df, "n", ("run_id",), ("time", "hit_id"), width).collect()}
    assert got == {r[2]: i for i, r in enumerate(order)}
    prev = {r.hit_id: r.prev_time for r in ordered.previous_row(df, ["time"], ("run_id",), ("time", "hit_id"), width).collect()}
    assert prev == {r[2]: (order[i - 1][0] if i else None) for i, r in enumerate(order)}


def test_empty_tables(spark):
    empty = frame(spark, [])
    assert iv.merge_intervals(empty).count() == 0
    assert iv.coincidence(empty, 2, 10).count() == 0
    assert iv.overlap_join(empty, empty.withColumnRenamed("hit_id", "w")).count() == 0


def test_no_nested_loop_and_no_single_task(spark):
    df = frame(spark, [(1, 2, 3)])
    plan = iv.overlap_join(df, df.withColumnRenamed("hit_id", "w"))._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
