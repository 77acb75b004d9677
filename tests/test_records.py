"""Pulse processing and saturation, on cases by hand."""

import pytest
from pyspark.sql import functions as F

from chronofold.operators import records

RAW = "run_id string, channel int, pulse long, record_i int, length int, data array<int>"


def test_fragments_share_the_baseline_and_lose_what_is_far_from_hits(spark):
    first, second, alone = [100] * 6 + [40] + [100] * 3, [100, 100, 100, 30, 100, 100, 100, 100, 5, 5], [90] * 10
    raw = spark.createDataFrame([("0", 1, 0, 0, 10, first), ("0", 1, 0, 1, 8, second), ("0", 2, 0, 1, 10, alone)], RAW)
    key = ["run_id", "channel", "record_i"]
    got = {(r.channel, r.record_i): r for r in records.process_records(raw, key, 50, 4, 1, 1, ceiling=100).collect()}
    assert got[1, 0].data == [0] * 6 + [60, 0, 0, 0] and got[1, 0].n_hits == 1 and got[1, 0].baseline == 100 and got[1, 0].saturated
    # The second fragment alone would have a baseline of 82.5; beyond its 8 samples there is nothing.
    assert got[1, 1].baseline == 100 and got[1, 1].data == [0, 0, 0, 70, 0, 0, 0, 0, 0, 0] and got[1, 1].area == 70
    assert got[2, 1].baseline == 90 and got[2, 1].n_hits == 0 and not got[2, 1].saturated
    filtered = records.process_records(raw, key, 50, 4, 1, 1, kernel=[0.5, 0.5]).collect()
    assert all(r.n_hits == 0 for r in filtered)
    assert records.process_records(raw.where(F.lit(False)), key, 50).count() == 0


def test_an_empty_fragment_has_no_baseline(spark):
    raw = spark.createDataFrame([("0", 1, 0, 0, 0, [])], RAW)
    row = records.process_records(raw, ["channel"], 50).first()
    assert row.baseline is None and row.data == [] and row.area == 0


def test_saturated_samples_follow_the_others(spark):
    rows = [(1, c, [0, 2, 4, 24, 20, 10]) for c in range(4)] + [(1, 9, [0, 5, 10, 25, 25, 5]), (1, 8, [0, 20, 24, 25, 24, 5]), (2, 0, [1, 2, 3, 4, 25, 6])]
    df = spark.createDataFrame(rows, "peak int, channel int, data array<int>")
    got = {(r.peak, r.channel): r.result for r in records.corrected_saturation(df, ["peak", "channel"], ["peak"], 25, min_reference=5).collect()}
    assert got[1, 0] == [0, 2, 4, 24, 20, 10]
    # Before saturation it has 15 of the reference's 24: what follows is 15/24 of the reference, and never less than was recorded.
    assert got[1, 9] == pytest.approx([0, 5, 10, 60, 50, 25])
    # More than the reference before saturation, or no reference: left alone.
    assert got[1, 8] == [0, 20, 24, 25, 24, 5] and got[2, 0] == [1, 2, 3, 4, 25, 6]
