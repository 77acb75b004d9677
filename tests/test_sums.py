"""Sums per peak and rebuilt saturated records against loops over samples."""

import math
import os
import random

import pytest

from chronofold.operators import sums
from chronofold.session import unpin

SCHEMA = "run_id string, record_id long, time long, endtime long, channel int, dt int, data array<int>, gain double, baseline double, ceiling double"
DT, CHANNELS, TOP = 10, 6, 3


def made(seed, n=300, high=40):
    rng, rows = random.Random(seed), []
    for i in range(n):
        run, m = rng.choice(["0", "1", None]), rng.randint(1, 30)
        t = rng.randint(0, 4000) * DT
        rows.append((run, i, t, t + m * DT, rng.randint(0, CHANNELS - 1), DT, [rng.randint(0, high) for _ in range(m)], rng.choice([0.5, 1.0, 2.0]), float(high), float(high)))
    rng2 = random.Random(seed + 1)
    peaks, at = [], {"0": 0, "1": 0, None: 0}
    for k in range(90):
        run = rng2.choice(["0", "1", None])
        a = at[run] + rng2.randint(0, 60) * DT
        b = a + rng2.choice([3, 20, 450]) * DT
        at[run] = b
        peaks.append((run, k, a, b))
    return peaks, rows


def frames(spark, peaks, rows):
    return spark.createDataFrame(peaks, "run_id string, peaklet long, time long, endtime long").repartition(3), spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.mark.parametrize("most", [7, 200])
def test_sums_equal_loops(spark, most):
    peaks, rows = made(1)
    got = {(r.run_id, r.peaklet): r for r in sums.peak_waveforms(*frames(spark, peaks, rows), CHANNELS, TOP, DT, most).collect()}
    seen = 0
    for run, k, a, b in peaks:
        wave, top, per, full, met = [0.0] * ((b - a) // DT), [0.0] * ((b - a) // DT), [0.0] * CHANNELS, set(), False
        for r in rows:
            if r[0] != run or not (r[2] < b and a < r[3]):
                continue
            met = True
            for i, v in enumerate(r[6]):
                p = (r[2] + i * DT - a) // DT
                if 0 <= p < len(wave):
                    wave[p] += v * r[7]
                    per[r[4]] += v * r[7]
                    top[p] += v * r[7] if r[4] < TOP else 0
                    if v >= r[9]:
                        full.add(r[4])
        assert ((run, k) in got) == met
        if not met:
            continue
        seen += 1
        r, factor = got[run, k], math.ceil(len(wave) / most)
        shrunk = lambda w: [sum(w[i : i + factor]) for i in range(0, len(w), factor)]  # noqa: B023, E731
        assert r.dt == factor * DT and r.length == len(r.data) <= most and r.time == a and r.n_saturated == len(full)
        assert list(r.data) == pytest.approx(shrunk(wave)) and list(r.data_top) == pytest.approx(shrunk(top)) and list(r.area_per_channel) == pytest.approx(per)
        assert r.area == pytest.approx(sum(per)) == pytest.approx(sum(r.data))
    assert seen > 40


def rebuilt(peaks, rows, reference, least):
    out = {}
    for run, _, a, b in sorted(peaks, key=lambda p: (str(p[0]), p[2])):
        inside = [r for r in rows if r[0] == run and r[2] < b and a < r[3]]
        n = (b - a) // DT
        at = lambda r, i: (r[2] + i * DT - a) // DT  # noqa: B023, E731
        full = {r[4] for r in inside for i, v in enumerate(r[6]) if 0 <= at(r, i) < n and v >= min(x[8] for x in inside if x[4] == r[4])}
        model = [0.0] * n
        for r in inside:
            for i, v in enumerate(r[6]):
                if 0 <= at(r, i) < n and r[4] not in full:
                    model[at(r, i)] += v * r[7]
        for c in full:
            own = [r for r in inside if r[4] == c]
            pulse, gain = [0] * n, own[0][7]
            for r in own:
                for i, v in enumerate(r[6]):
                    if 0 <= at(r, i) < n:
                        pulse[at(r, i)] += v
            s0 = next(i for i, v in enumerate(pulse) if v >= min(r[8] for r in own))
            ref = range(max(0, s0 - reference), s0)
            p, m = sum(pulse[i] for i in ref), sum(model[i] for i in ref)
            if sum(pulse[i] * gain > 1 for i in ref) < least or sum(model[i] > 1 for i in ref) < least or p * gain / m > 1:
                continue
            for r in own:
                spots = [i for i in range(len(r[6])) if s0 <= at(r, i) < n]
                if spots:
                    data, high = out.get((run, r[1]), (list(r[6]), 0.0))
                    for i in spots:
                        data[i] = int(model[at(r, i)] * p / m)
                        high = max(high, model[at(r, i)] * p / m)
                    out[run, r[1]] = (data, high)
    return {k: ([v >> (s := int(math.floor(math.log2(h) - 14)) if h >= 1 << 15 else 0) for v in d], sum(d), s) for k, (d, h) in out.items()}


@pytest.mark.parametrize(("high", "seed"), [(40, 3), (16000, 5)])
def test_saturated_records_follow_the_others(spark, high, seed):
    """One gain a channel; records of different starts, lengths and several of one channel in a peak."""
    rng, peaks, rows, n = random.Random(seed), [], [], 0
    for k in range(40):
        a = k * 10_000
        m = rng.randint(60, 120)
        peaks.append(("0", k, a, a + m * DT))
        shape = [max(1, int(high * math.exp(-(((i - m * 0.6) / 18) ** 2)))) for i in range(m + 10)]
        for c in range(CHANNELS):
            height, start = rng.choice([0.4, 0.8, 1.6]), rng.randint(-3, 3)
            cuts = [0, rng.randint(20, 50), m]
            for x, y in zip(cuts, cuts[1:]):
                data = [min(high, int(shape[i] * height)) for i in range(x, y)]
                rows.append(("0", n, a + (x + start) * DT, a + (y + start) * DT, c, DT, data, 1.0 + c / 4, float(high), float(high)))
                n += 1
    got = {(r.run_id, r.record_id): (list(r.data), r.area, r["shift"]) for r in sums.desaturated_records(*frames(spark, peaks, rows), DT, 100, 20).collect()}
    want = rebuilt(peaks, rows, 100, 20)
    assert set(got) == set(want) and len(want) > 15
    for k, (data, area, shift) in want.items():
        assert got[k][2] == shift and got[k][0] == pytest.approx(data, abs=1) and got[k][1] == pytest.approx(area, abs=len(data))
    assert (max(s for *_, s in want.values()) > 0) == (high > 1000)
    assert sums.desaturated_records(*frames(spark, peaks[:1], []), DT).count() == 0
    unpin()
