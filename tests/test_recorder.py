"""The veto recorder against loops over the given records."""

import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from chronofold.operators import recorder as rec
from chronofold.session import unpin

SF = "/root/testdata/sf0.001"


def recorded(rows, threshold, n, resolving, pre, seconds, baseline_samples):
    """record -> (bypassed, kept, baseline, area), of one run."""
    start, end = min(r["time"] for r in rows), max(r["endtime"] for r in rows)
    out, hits = {}, []
    pulses = {}
    for r in rows:
        pulses.setdefault(r["pulse"], []).append(r)
    for own in pulses.values():
        head = next((r for r in own if r["record_i"] == 0), None)
        for r in own:
            base = (head or r)["data"][:baseline_samples]
            base = sum(base) / len(base)
            wave = [base - v if i < r["length"] else 0.0 for i, v in enumerate(r["data"])]
            early = r["time"] - r["record_i"] * len(wave) * r["dt"] < start + int(seconds * 1e9)
            out[r["record_id"]] = [early, early, base, sum(wave)]
            if not early:
                hits += [r["time"] + i * r["dt"] for i, v in enumerate(wave) if v >= threshold and (i == 0 or wave[i - 1] < threshold)]
    hits.sort()
    spans = [(t - pre, t + resolving) for t, far in zip(hits, hits[n - 1 :]) if far - t < resolving]
    if spans:
        spans += [(start, min(start + resolving, min(a for a, _ in spans))), (max(end - resolving, max(b for _, b in spans)), end)]
    for own in pulses.values():
        if any(a < b and r["time"] < b and a < r["endtime"] for r in own if not out[r["record_id"]][0] for a, b in spans):
            for r in own:
                out[r["record_id"]][1] = True
    return out


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
def test_queries_equal_loops(spark):
    from chronofold.plans import peak_queries as q

    rows = [r.asDict() for r in q._raw(spark, SF).collect()]
    want = recorded(rows, **q._TRIGGER)
    got = {r.record_id: [r.bypassed, r.kept, r.baseline, r.area] for r in q.veto_recorder(spark, SF).collect()}
    assert set(got) == set(want)
    assert all(got[k][:2] == want[k][:2] and got[k][2:] == pytest.approx(want[k][2:], abs=1e-3) for k in want)
    assert len({tuple(v[:2]) for v in want.values()}) == 3
    lone = [r for r in rows if not want[r["record_id"]][1]]
    for s in q.veto_lone_statistics(spark, SF).collect():
        own = [r for r in lone if r["channel"] == s.channel]
        first = [want[r["record_id"]] for r in own if r["record_i"] == 0]
        assert (s.n_fragments, s.n_higher_fragments) == (len(own), len(own) - len(first))
        assert s.mean_area == pytest.approx(sum(w[3] for w in first) / len(first), abs=1e-3) if first else s.mean_area is None
    unpin()


def test_numbers_of_the_one_scan(spark):
    schema = "run_id string, record_id long, pulse long, channel int, record_i int, dt int, time long, endtime long, length int, data array<int>"
    quiet, loud = [100] * 10, [100] * 4 + [20] * 2 + [100] * 4
    rows = [("0", i, i, i, 0, 10, 1000 * i, 1000 * i + 100, 10, quiet) for i in range(4)] + [("0", 10 + i, 10 + i, i, 0, 10, 50_000 + 5 * i, 50_100 + 5 * i, 10, loud) for i in range(3)]
    rows += [("0", 20, 10, 0, 1, 10, 50_100, 50_200, 10, quiet), ("1", 30, 30, 0, 0, 10, 7, 107, 10, loud), (None, 31, 31, 0, 0, 10, 7, 107, 10, quiet)]
    raw = spark.createDataFrame(rows, schema)
    bounds = raw.groupBy("run_id").agg(F.lit(0).cast("long").alias("start"), F.lit(100_000).cast("long").alias("end"))
    seen = Observation("veto")
    got = {r.record_id: (r.bypassed, r.kept) for r in rec.record_veto(raw, 50, 3, 200, 20, bounds, 1.5e-6, 4, observed=seen).collect()}
    # Pulses 0 and 1 come in the first 1.5 us, as do those of the other runs; the second fragment of pulse 10 is kept with it.
    assert got == {0: (True, True), 1: (True, True), 2: (False, False), 3: (False, False), 10: (False, True), 11: (False, True), 12: (False, True), 20: (False, True), 30: (True, True), 31: (True, True)}
    assert seen.get == {"records": 10, "kept": 8, "bypassed": 4}
    everything = rec.record_veto(raw, 50, 3, 200, 20, bounds, -1)
    assert everything.where("not kept").count() == 0 and rec.lone_statistics(everything).count() == 0
    unpin()
