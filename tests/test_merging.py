"""Merging gap after gap against a plain reading of its rules, and the executor that runs it over whole islands."""

import math
import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chronofold.operators import executor, merging
from chronofold.operators.merging import MergeRules
from chronofold.session import unpin

SF = "/root/testdata/sf0.001"


def curve(x, points):
    if x < points[0][0]:
        return points[0][1]
    for (x0, y0), (x1, y1) in zip(points, points[1:]):
        if x < x1:
            return (x - x0) * (y1 - y0) / (x1 - x0) + y0
    return points[-1][1]


def goodness(parts, origin):
    """Sample by sample: spread of what is left of and with each sample, and of what is right of and with it."""
    samples = [(p["time"] - origin + p["dt"] * (i + 0.5), max(v, 0.0), p["dt"]) for p in parts for i, v in enumerate(p["data"])]

    def spread(rows):
        w = sum(r[1] for r in rows)
        return sum(r[1] * r[0] * r[0] for r in rows) - sum(r[1] * r[0] for r in rows) ** 2 / w if w > 0 else 0.0

    whole, top = spread(samples), max(r[1] / r[2] for r in samples)
    if whole <= 1e-12 * sum(r[1] * r[0] * r[0] for r in samples):
        return -1.0  # nothing to split
    out = []
    for k, (_, w, d) in enumerate(samples):
        g = 1 - (spread(samples[: k + 1]) + spread(samples[k:])) / whole
        out.append(g * (1 - w / d / top) if top > 0 else g)
    return min(max(out), 1.0)


def merged(peaks, rules):
    """Lists of peaks that become one, of one run in time order, without islands."""
    peaks = [p for p in peaks if not (rules.without_s1 and p["type"] == 1)]
    group = {i: (i, i) for i in range(len(peaks))}
    gaps = sorted((peaks[i + 1]["time"] - peaks[i]["endtime"], i) for i in range(len(peaks) - 1))
    for gap, i in gaps:
        if gap > rules.gaps[0][1]:
            break
        a, b = group[i][0], group[i + 1][1]
        own = peaks[a : b + 1]
        size = sum(p["area"] for p in own)
        log = math.log10(size) if size > 0 else -math.inf
        if size > 10 ** rules.gaps[-1][0] or (size > 0 and gap > curve(log, rules.gaps)) or own[-1]["endtime"] - own[0]["time"] >= rules.max_duration:
            continue
        if rules.spreads:
            w = [p["area"] * p["area_fraction_top"] for p in own]
            if all(v > 0 for v in w) and all(p["x"] is not None and p["y"] is not None for p in own):
                cx, cy = (sum(v * p[c] for v, p in zip(w, own)) / sum(w) for c in "xy")
                if sum(v * math.hypot(p["x"] - cx, p["y"] - cy) for v, p in zip(w, own)) / sum(w) > curve(math.log10(sum(w)), rules.spreads):
                    continue
        if rules.splits and goodness(own, peaks[i + 1]["time"]) > curve(log, rules.splits):
            continue
        for k in range(a, b + 1):
            group[k] = (a, b)
    out = []
    for a, b in sorted(set(group.values())):
        while peaks[a]["type"] != 2 and b - a > 1:
            a += 1
        if peaks[a]["type"] == 2 and b > a:
            out.append([p["peaklet"] for p in peaks[a : b + 1]])
    return out


SCHEMA = "run_id string, peaklet long, time long, endtime long, type int, area double, area_fraction_top double, x double, y double, dt long, data array<double>"


def peaks(seed, n=120):
    rng, out = random.Random(seed), []
    for run in ("0", "1", None):
        t = 0
        for i in range(n):
            t += rng.choice([0, 10, 300, 1500, 2500, 4000, 6000])
            dt, m = rng.choice([10, 20]), rng.randint(1, 12)
            data = [rng.choice([0.0, 1.0, 5.0, -0.5]) * rng.uniform(0.2, 60) for _ in range(m)]
            area = sum(data) if rng.random() < 0.95 else -1.0
            out.append((run, i, t, t + dt * m, rng.choice([2, 2, 2, 1, 0]), area, rng.uniform(0.2, 0.9), rng.uniform(-12, 12) if rng.random() < 0.95 else None, rng.uniform(-12, 12), dt, data))
            t += dt * m
    return out


@pytest.mark.parametrize("rules", [MergeRules(), MergeRules(splits=None), MergeRules(spreads=merging.SPREADS, without_s1=False), MergeRules(splits=None, max_duration=4000, without_s1=False)])
def test_merges_equal_a_plain_reading(spark, rules):
    rows = peaks(4)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {}
    for r in merging.assign_merges(df, rules, "data", key="peaklet", width=20_000).where("merged").collect():
        got.setdefault((r.run_id, r.cluster), []).append(r.peaklet)
    want = {}
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    for run in ("0", "1", None):
        for m in merged([dict(zip(names, r)) for r in rows if r[0] == run], rules):
            want[run, m[0]] = m
    assert {k: sorted(v) for k, v in got.items()} == want and len(want) > 10


def test_merged_peaks_add_up(spark):
    rows = [("0", 0, 0, 40, 2, 10.0, 0.5, 0.0, 0.0, 10, [1.0, 2.0, 3.0, 4.0]), ("0", 1, 50, 90, 2, 6.0, 0.5, 8.0, 4.0, 20, [2.0, 4.0]), ("0", 2, 10**6, 10**6 + 10, 2, 1.0, 0.5, 0.0, 0.0, 10, [1.0])]
    lone = spark.createDataFrame([("0", 7, 41, 44, 2.5), ("0", 8, 500, 510, 9.0)], "run_id string, hit_id long, time long, endtime long, area double")
    got = merging.merge_s2(spark.createDataFrame(rows, SCHEMA), MergeRules(splits=None), "data", lone_hits=lone, key="peaklet").collect()
    assert len(got) == 1
    r = got[0]
    assert (r.time, r.endtime, r.area, r.n_merged, r.first_id, r.dt) == (0, 90, 18.5, 2, 0, 10) and (r.x, r.y) == (3.0, 1.5)
    assert list(r.data) == [1, 2, 3, 4, 0, 1, 1, 2, 2] and sum(r.data) == 16
    assert merging.merge_s2(spark.createDataFrame([], SCHEMA), key="peaklet").count() == 0


@pytest.mark.parametrize("rows", [1, 3, 10_000])
def test_islands_come_whole(spark, rows):
    rng = random.Random(rows)
    data = [(rng.choice(["a", None]), rng.choice([1, 2, 3, 4]), i) for i in range(300)] + [("hot", 9, i) for i in range(400)]
    df = spark.createDataFrame(data, "run_id string, island long, v long").repartition(4)

    def kernel(batch, starts):
        ends = np.append(starts[1:], batch.num_rows)
        v = batch.column("v").to_numpy()
        assert all((np.diff(v[a:b]) > 0).all() for a, b in zip(starts, ends))
        at = pa.array(starts)
        return pa.RecordBatch.from_arrays([batch.column("run_id").take(at), batch.column("island").take(at), pa.array(ends - starts)], names=["run_id", "island", "n"])

    got = executor.map_islands(df, kernel, "run_id string, island long, n long", ["v"], rows=rows)
    want = df.groupBy("run_id", "island").agg(F.count(F.lit(1)).alias("n"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
def test_registered_query_equals_a_plain_reading(spark):
    from chronofold.plans import chain_queries as cq

    runs = {}
    for r in cq._sampled(spark, SF).collect():
        runs.setdefault(r.run_id, []).append(r.asDict())
    want = []
    for run, rows in runs.items():
        rows.sort(key=lambda r: r["time"])
        by = {r["peaklet"]: r for r in rows}
        for m in merged(rows, cq.MERGE_RULES):
            want.append((run, m[0], by[m[0]]["time"], by[m[-1]]["endtime"], round(sum(by[k]["area"] for k in m), 4), len(m)))
    got = [(r.run_id, r.cluster, r.time, r.endtime, r.area, r.n_merged) for r in cq.s2_merge_islands(spark, SF).collect()]
    unpin()
    assert sorted(got) == sorted(want) and len(want) > 3
