"""Rows without a run or channel are a group of their own, and plans stay small."""

import random

import pytest
from pyspark.sql import functions as F

from chronofold.operators import intervals as iv
from chronofold.operators import merging, monitor, ordered
from chronofold.operators import neighbourhood as nb
from chronofold.operators import peaklets as pk
from chronofold.session import pinned, unpin

SCHEMA = "run_id string, hit_id long, time long, endtime long, center_time long, channel long, type int, area double, x double, y double"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    return [(rng.choice(["0", None]), i, t := rng.randint(0, 3000), t + rng.randint(0, 40), t + 3, rng.choice([1, 2, None]), rng.choice([1, 2]), float(rng.randint(1, 90)), rng.random(), rng.random()) for i in range(150)]


def some(df):
    return df.where("hit_id % 7 = 0")


def boxes(df):
    return iv.merge_intervals(some(df), width=100).withColumn("box", F.col("time"))


OPERATORS = {
    "running": lambda d: ordered.running_sum(ordered.running_max_before(d, "endtime", "m", ["run_id"], ["time", "hit_id"], 100), "area", "s", ["run_id"], ["time", "hit_id"], 100),
    "neighbours": lambda d: ordered.neighbours(d, ["time"], ["time"], ["run_id"], ["time", "hit_id"], 100, reach="endtime"),
    "fill": lambda d: ordered.fill_backward(ordered.fill_forward(d.withColumn("v", F.when(F.col("hit_id") % 5 == 0, F.col("area"))), "v", "f", ["run_id"], ["time", "hit_id"], 100), "v", "g", ["run_id"], ["time", "hit_id"], 100),
    "numbers": lambda d: ordered.row_numbers(d, "n", ["run_id", "channel"], ["time", "hit_id"], 100),
    "islands": lambda d: iv.islands(d, "endtime", 20, order=("time", "hit_id"), width=100),
    "coincidence": lambda d: iv.coincidence(d, 3, 60, 5, width=100),
    "overlap": lambda d: iv.overlap_join(d, some(d), width=10),
    "split": lambda d: iv.split_by_containment(d, boxes(d), "box", width=100),
    "containing": lambda d: iv.containing(d, boxes(d), "box", "hit_id", width=100),
    "outside": lambda d: iv.outside(d, boxes(d), "hit_id", width=100),
    "outside_disjoint": lambda d: iv.outside(d, boxes(d), "hit_id", width=100, disjoint=True),
    "nearest": lambda d: iv.nearest(d, some(d).withColumnRenamed("hit_id", "k"), ["area"], right_key="k", width=100),
    "nearest_absolute": lambda d: iv.nearest_absolute(d, some(d), ["area"], width=100),
    "overlap_duration": lambda d: iv.overlap_duration(d, boxes(d), "hit_id", width=100),
    "overlaps": lambda d: iv.check_overlaps(d, width=100),
    "isolated": lambda d: iv.isolated(d, 15, width=100),
    "proximity": lambda d: nb.proximity(d, 200),
    "competing": lambda d: nb.competing(d, 200),
    "peaklets": lambda d: pk.find_peaklets(d.fillna({"channel": 9}), 10, width=100),
    "veto_events": lambda d: pk.veto_events(d, 3, 60, 5, width=100),
    "replace_merged": lambda d: merging.replace_merged(d, boxes(d).select("run_id", "time", "endtime", *[F.lit(None).cast(f.dataType).alias(f.name) for f in d.schema if f.name not in ("run_id", "time", "endtime")]).select(d.columns), width=100),
    "pulse_counts": lambda d: monitor.pulse_counts(d.withColumn("lone", F.lit(True))) if hasattr(monitor, "pulse_counts") else d,
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_null_is_a_run_like_any_other(spark, rows, name):
    named = [tuple("z" if k == 0 and v is None else 9 if k == 5 and v is None else v for k, v in enumerate(r)) for r in rows]
    flat = lambda found: sorted(str({k: "z" if v is None and k == "run_id" else 9 if v is None and k.endswith("channel") else f"{v:.9g}" if isinstance(v, float) else v for k, v in r.asDict().items()}) for r in found.collect())
    have, want = (flat(OPERATORS[name](spark.createDataFrame(r, SCHEMA))) for r in (rows, named))
    assert have == want and len(want) > 1
    unpin()


def leaves(df):
    return df._jdf.queryExecution().analyzed().collectLeaves().size()


@pytest.mark.parametrize(("name", "most"), [("isolated", 2), ("islands", 2), ("veto_events", 8), ("coincidence", 2)])
def test_inputs_are_named_a_few_times(spark, rows, name, most):
    df = spark.createDataFrame(rows, SCHEMA)
    assert leaves(OPERATORS[name](df)) <= most
    unpin()


def test_event_plans_are_small(spark):
    from chronofold.plans import registry

    registry.load()
    for name in ("event_basics", "veto_events", "event_building"):
        assert leaves(registry.QUERIES[name](spark, "/root/testdata/sf0.001")) <= 8, name
    unpin()


def test_pinned_tables_go_with_unpin(spark):
    df = pinned(spark.range(5).selectExpr("id", "array(struct(id AS a)) AS b", "cast(null AS string) AS c"))
    assert df.count() == 5 and "chronofold-pinned" in df.inputFiles()[0]
    unpin()
    import os

    assert not os.path.exists(df.inputFiles()[0].removeprefix("file://"))


@pytest.mark.parametrize("reach", [(0, 0), (40, 25), (700, 0)])
def test_tight_coincidence_makes_no_pairs(spark, rows, reach):
    """The same as a plain loop, and no join of hits with windows: their pairs grew with the square of the rate."""
    df = spark.createDataFrame([(*r[:5], i % 5 or None, *r[6:]) for i, r in enumerate(rows)], SCHEMA)
    got = nb.tight_coincidence(some(df), df, *reach, key="hit_id", width=100)
    assert "_level" not in got._jdf.queryExecution().analyzed().toString()
    data = df.collect()
    near = lambda p: {h.channel for h in data if h.run_id == p.run_id and h.channel is not None and p.time - reach[0] <= h.time <= p.time + reach[1]}
    assert {(r.run_id, r.hit_id): r.tight_coincidence for r in got.collect()} == {(p.run_id, p.hit_id): len(near(p)) for p in data if p.hit_id % 7 == 0}


#: Peaks that last a whole run, end before they begin, have no area or place, or share all with others.
ODD = [("0", 1000, 5, 5 + 10**7, 900, 1, 2, 70.0, 0.5, 0.5), ("0", 1001, 700, 650, 690, 1, 2, 60.0, 0.1, 0.2), ("0", 1002, 800, 800, 800, 1, 1, None, None, 0.3),
       (None, 1003, 0, 10**9, 10**8, 1, 1, 80.0, 0.5, None), ("0", 1004, 1200, 1300, 1250, 1, 2, 88.0, 0.4, 0.4), ("0", 1005, 1200, 1300, 1250, 1, 2, 88.0, 0.4, 0.4), ("0", 1006, 50, 60, 2000, 1, 2, 88.0, 0.4, 0.4)]


def test_scores_of_odd_peaks_equal_a_plain_loop_and_make_no_pair_rows(spark, rows, monkeypatch):
    data = spark.createDataFrame([*rows, *ODD], SCHEMA).collect()
    df = spark.createDataFrame(data, SCHEMA)
    found = {"n": nb.competing(df, 200), "s": nb.shadow(df.where("area > 0"), 200, 20.0, 2, position=True), "t": nb.shadow(df, 200, 20.0, 2), "a": nb.ambience(df, df.where("type = 1"), 200, {1: 50, 2: 85}, 0.4)}
    assert not any("w_ct" in x._jdf.queryExecution().analyzed().toString() for x in found.values())
    got = {n: {r.hit_id: r for r in x.collect()} for n, x in found.items()}
    here = lambda p, o, ahead: o.run_id == p.run_id and o.time < p.center_time + ahead and o.endtime > p.center_time - 200
    far = lambda p, o: 132.8 if None in (p.x, p.y, o.x, o.y) else ((p.x - o.x) ** 2 + (p.y - o.y) ** 2) ** 0.5
    for p in data:
        near = [o for o in data if here(p, o, 200) and o.area is not None and p.area is not None and o.area > p.area * 0.2]
        r = got["n"][p.hit_id]
        assert (r.n_competing, r.n_competing_left) == (len(near), sum(o.center_time < p.center_time for o in near))
        casting = [o for o in data if here(p, o, 0) and o.center_time < p.center_time and o.type == 2 and (o.area or 0) > 20]
        if p.area:
            scale = 15.0 / p.area**0.5
            values = [o.area / (p.center_time - o.center_time) * 2 / (3.141592653589793 * scale * (1 + (far(p, o) / scale) ** 2)) for o in casting]
            assert got["s"][p.hit_id].shadow == pytest.approx(max(values, default=0.1))
        r, best = got["t"][p.hit_id], max(casting, key=lambda o: (o.area / (p.center_time - o.center_time), -o.center_time), default=None)
        assert (r.shadow, r.dt, r.x) == pytest.approx((best.area / (p.center_time - best.center_time), p.center_time - best.center_time, best.x) if best else (0.1, 200.0, None))
        assert r.nearest_dt == min((p.center_time - o.center_time for o in casting), default=None)
        small = [o for o in data if here(p, o, 0) and o.center_time < p.center_time and o.type == 2 and o.area is not None and o.area < 85]
        lone = [o for o in data if here(p, o, 0) and o.time < p.center_time and o.type == 1 and o.area]
        r = got["a"][p.hit_id]
        assert (r.n_lh_before, r.n_s2_before, r.n_s2_near) == (len(lone), len(small), sum(far(p, o) <= 0.4 for o in small))
        assert r.s_lh_before == pytest.approx(sum(o.area / (p.center_time - o.time) for o in lone)) and r.s_s2_before == pytest.approx(sum(o.area / (p.center_time - o.center_time) for o in small))


def test_counts_without_pairs_and_blocks_of_bounded_size():
    import numpy as np

    rng = np.random.default_rng(3)
    values, upto, limits = rng.integers(0, 40, 500).astype(float), rng.integers(0, 501, 300), rng.integers(-2, 43, 300).astype(float)
    assert nb.above(values, upto, limits).tolist() == [int((values[:k] > v).sum()) for k, v in zip(upto, limits)]
    time = np.sort(rng.integers(0, 5000, 3000))
    side = lambda end, name: nb.Side(time, end, time + 1, None, {name: rng.integers(1, 90, 3000).astype(float)})
    p, c = side(time + 400, "area"), side(time + rng.integers(-3, 90, 3000), "a")
    p.centre = time + 200
    assert all(met.size <= nb.BLOCK for _, _, _, met in nb.blocks(p, c))
    met = (c.time < p.end[:, None]) & (p.time[:, None] < c.end) & (c["a"] > p["area"][:, None] * 0.2)
    got = nb._competing(0.2, p, c)
    assert got["n"].tolist() == met.sum(axis=1).tolist() and got["left"].tolist() == (met & (c.centre < p.centre[:, None])).sum(axis=1).tolist()
