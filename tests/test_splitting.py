"""Split trees against a plain reading, and merged casting peaks."""

import math
import os
import random

import numpy as np
import pytest

from chronofold.operators import neighbourhood as nb
from chronofold.operators import splitting as sp
from chronofold.session import unpin

SF = "/root/testdata/sf0.001"


def goodness(w):
    """Gain of a cut before each sample, by sums over all samples."""
    def spread(part, at):
        v = [max(x, 0.0) for x in part]
        n = sum(v)
        return sum(x * t * t for x, t in zip(v, at)) - sum(x * t for x, t in zip(v, at)) ** 2 / n if n > 0 else 0.0

    whole = spread(w, range(len(w)))
    return [min(max(1 - (spread(w[:i], range(i)) + spread(w[i:], range(i, len(w)))) / whole, 0), 1) if whole > 0 else 0.0 for i in range(len(w))]


def leaves(w, dt, rules, depth=0, at=0):
    area = sum(w)
    if area >= rules.least_area and depth < rules.depth:
        wing = int(rules.wing // dt)
        mean = [np.mean([max(x, 0.0) for x in w[max(i - wing, 0) : i + wing + 1]]) for i in range(len(w))]
        gain = [g * (1 - m / max(mean)) if rules.prefer_low and max(mean) > 0 else g for g, m in zip(goodness(w), mean)]
        cut = max(range(len(w)), key=lambda i: (round(gain[i], 12), -i))
        filled = np.concatenate([[0], np.cumsum(np.maximum(w, 0))])
        rise = np.interp(0.5 * filled[-1], filled, np.arange(len(w) + 1)) - np.interp(0.1 * filled[-1], filled, np.arange(len(w) + 1))
        share = 1 / (1 + math.exp(-8 * math.log10(min(max(rise * dt, 1), 1e5) / 100)))
        size = math.log10(min(max(area, 1), 1e7))
        limit = share * np.interp(size, *zip(*rules.s2)) + (1 - share) * np.interp(size, *zip(*rules.s1))
        if 0 < cut < len(w) and gain[cut] > limit:
            return leaves(w[:cut], dt, rules, depth + 1, at) + leaves(w[cut:], dt, rules, depth + 1, at + cut)
    return [(at, at + len(w), depth)]


@pytest.mark.parametrize("rules", [sp.SplitRules(), sp.SplitRules(prefer_low=False, depth=2), sp.SplitRules(least_area=500.0)])
def test_tree(rules):
    rng, cuts = random.Random(3), 0
    for _ in range(40):
        n = rng.randint(1, 60)
        tops = [(rng.uniform(0, n), rng.uniform(1, 4), rng.uniform(5, 80)) for _ in range(rng.randint(1, 4))]
        w = [sum(h * math.exp(-(((i - m) / s) ** 2)) for m, s, h in tops) + rng.uniform(-0.1, 0.3) for i in range(n)]
        found = sp.split_tree(np.array(w), 40, rules)
        assert found == leaves(w, 40, rules)
        cuts += len(found) - 1
    assert cuts > 3


def test_pieces_add_up_and_hits_follow(spark):
    w = [0.0, 9.0, 30.0, 9.0, 0.0, 0.0, 0.0, 0.0, 0.0, 8.0, 40.0, 9.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 7.0, 35.0, 8.0]
    df = spark.createDataFrame([(None, 0, 1000, 100, w), ("0", 1, 5000, 100, [5.0, 30.0, 6.0]), ("0", 2, 9000, 100, [])], "run_id string, peaklet long, time long, dt long, data array<double>")
    pieces = sp.split_peaklets(df, sp.SplitRules(s1=((1.0, 0.65),), s2=((1.0, 0.65),)))
    got = {(r.run_id, r.peaklet, r.piece): r for r in pieces.collect()}
    assert sorted(k[1:] for k in got) == [(0, 0), (0, 1), (0, 2), (1, 0)]
    mine = [got[None, 0, k] for k in range(3)]
    assert [x for r in mine for x in r.data] == w and sum(r.area for r in mine) == sum(w)
    assert [r.endtime for r in mine[:-1]] == [r.time for r in mine[1:]] and (mine[0].time, mine[-1].endtime) == (1000, 1000 + 100 * len(w))
    # Half of 30: between samples of 9 and 30 on both sides.
    assert got["0", 1, 0].width_half == pytest.approx(100 * (1 + 2 * 0 + (30 - 15) / (30 - 5) + (30 - 15) / (30 - 6) - 1))
    assert math.isnan(sp.width_at(np.zeros(3), 1.0))
    hits = spark.createDataFrame([(None, 7, 1250), (None, 8, 2099), (None, 9, 2950), ("0", 10, 5000), ("0", 11, 5300), ("1", 12, 1250)], "run_id string, hit_id long, max_time long")
    dealt = {r.hit_id: (r.peaklet, r.piece) for r in sp.hits_of_pieces(pieces, hits).collect()}
    assert dealt == {7: (0, 0), 8: (0, 1), 9: (0, 2), 10: (1, 0)}


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
def test_registered_queries_equal_loops(spark):
    from test_sums import rebuilt

    from chronofold.operators import sums
    from chronofold.plans import peak_queries as q

    waves = q._waves(spark, SF, 90).collect()
    want = {(r.peaklet, k): (r.time + a * r.dt, r.time + b * r.dt, d) for r in waves for k, (a, b, d) in enumerate(leaves(list(r.data), r.dt, q.SPLIT_RULES))}
    got = {(r.peaklet, r.piece): (r.time, r.endtime, r.depth) for r in q.natural_breaks(spark, SF).collect()}
    assert got == want and len(want) > len(waves)

    records = q._records(spark, SF).collect()
    limit = {r.record_id: float(math.floor(r.ceiling * 0.75)) if r.channel in (0, 5) else 1e9 for r in records}
    rows = [("0", r.record_id, r.time, r.endtime, r.channel, r.dt, [min(v, int(limit[r.record_id])) for v in r.data], 1.0, limit[r.record_id]) for r in records]
    peaks = [(r.run_id, r.peaklet, r.time, r.endtime) for r in q._peaks(q._records(spark, SF)).collect()]
    want = {k[1]: v for k, v in rebuilt(peaks, rows, 30, 5).items()}
    got = {r.record_id: ([int(v) for v in r.data.split(",")], r.area, r["shift"]) for r in q.desaturated_records(spark, SF).collect()}
    assert set(got) == set(want) and len(want) > 0 and sums.TOP == 1 << 15
    assert all(got[k][0] == pytest.approx(want[k][0], abs=1) for k in want)
    unpin()


def test_three_peaks_linked_through_the_middle_one(spark):
    schema = "run_id string, hit_id long, time long, endtime long, center_time long, area double, x double, y double, type int, w double"
    rows = [("0", 0, 0, 10, 5, 10.0, 0.0, 0.0, 1, 1.0), ("0", 1, 20, 30, 25, 30.0, 6.0, 0.0, 2, float("inf")), ("0", 2, 40, 90, 45, 20.0, 3.0, 0.0, 2, 5.0), ("0", 3, 60, 70, 65, 1.0, 50.0, 0.0, 2, 1.0),
            ("0", 4, 300, 310, 305, 2.0, 0.0, 0.0, 2, 1.0), ("0", 5, 320, 330, 325, 4.0, None, 0.0, 2, 1.0), (None, 6, 0, 10, 5, 1.0, 0.0, 0.0, 2, 1.0), (None, 7, 1, 12, 6, 1.0, 1.0, 0.0, 2, 1.0)]
    df = spark.createDataFrame(rows, schema)
    flat = lambda d: sorted((r.run_id or "", r.hit_id, r.time, r.endtime, r.center_time, r.area, r.x, r.n_merged) for r in d.collect())
    got = flat(nb.merge_casting(df, 20, 3.5))
    assert ("0", 0, 0, 90, 45, 60.0, 4.0, 3) in got and ("", 6, 0, 12, 6, 2.0, 0.5, 2) in got and len(got) == 5
    assert ("0", 5, 320, 330, 325, 4.0, None, 1) in got
    mean = {r[:2]: r for r in flat(nb.merge_casting(df, 20, 3.5, nb.F.col("w"), last=False))}
    assert mean["0", 0][4:7] == (round((5 * 10 + 25 * 30 + 45 * 20) / 60), 60.0, 6.0)
    assert len(flat(nb.merge_casting(df, 20, 3.5, replace=False))) == len(rows) + 2
    assert {r[1]: r[7] for r in flat(nb.merge_casting(df, 20, 0.0)) if r[0]} == {0: 4, 4: 2}


def test_components_of_many_points():
    rng = random.Random(5)
    x, y = ([rng.uniform(0, 30) for _ in range(300)] for _ in range(2))
    first = nb.linked_places(np.array([*x, math.nan]), np.array([*y, 1.0]), 1.5)
    want = list(range(300))
    for _ in range(300):
        new = [min(want[j] for j in range(300) if math.hypot(x[i] - x[j], y[i] - y[j]) <= 1.5) for i in range(300)]
        if new == want:
            break
        want = new
    assert first.tolist() == [*want, 300]


def test_many_peaks_at_few_places_are_linked_by_place(spark):
    """20,000 peaks of one time cluster at 40 places: comparing each with all the others near it took minutes."""
    import time

    began = time.time()
    x, y = np.arange(20_000) % 8 * 3.0 + np.arange(20_000) % 2 * 100, np.arange(20_000) % 5 * 3.0
    first = nb.linked_places(x, y, 3.5)
    # Even and odd columns are 100 apart, and 6 within each: every column is alone, its rows are linked.
    assert len(set(first.tolist())) == 8 and all(len(set(x[first == f].tolist())) == 1 for f in set(first.tolist()))
    assert time.time() - began < 5
    rows = spark.range(20_000).selectExpr("'0' as run_id", "id as hit_id", "id as time", "id + 1 as endtime", "id as center_time", "1L as area", "double(id % 8 * 3) as x", "double(id % 5 * 9) as y", "2 as type")
    got = sorted((r.hit_id, r.n_merged) for r in nb.merge_casting(rows.repartition(3), 20, 3.5).collect())
    assert got == [(0, 4000), (1, 4000), (2, 4000), (3, 4000), (4, 4000)]
