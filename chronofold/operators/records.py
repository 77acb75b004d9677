"""Pulse processing: from raw fragments to records, as one shuffle by pulse and one pass in Arrow batches."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronofold.operators import waveform as wf

_RESULT = "struct<data:array<double>,area:double,n_hits:int,saturated:boolean>"


def with_baseline(raw: DataFrame, samples: int = 40, data: str = "data", pulse: Sequence[str] = ("run_id", "channel", "pulse")) -> DataFrame:
    """raw with baseline and baseline_rms: of the first samples of fragment 0, for all fragments of the pulse. Where fragment 0 is missing, a
    fragment's own first samples count."""
    head = F.slice(F.col(data), 1, samples)
    n = F.size(head)
    mean = F.try_divide(F.aggregate(head, F.lit(0.0), lambda a, x: a + x), n)
    own = raw.withColumn("_own", mean)
    square = F.aggregate(head, F.lit(0.0), lambda a, x: a + (x - F.col("_own")) * (x - F.col("_own")))
    own = own.withColumn("_rms", F.sqrt(F.try_divide(square, n)))
    w = Window.partitionBy(*pulse)
    first = lambda c: F.coalesce(F.max(F.when(F.col("record_i") == 0, F.col(c))).over(w), F.col(c))
    return own.withColumns({"baseline": first("_own"), "baseline_rms": first("_rms")}).drop("_own", "_rms")


def process_records(
    raw: DataFrame, key: Sequence[str], threshold: float, baseline_samples: int = 40, left: int = 3, right: int = 20, kernel: Sequence[float] = (), ceiling: float | None = None,
    data: str = "data", length: str = "length", pulse: Sequence[str] = ("run_id", "channel", "pulse"),
) -> DataFrame:
    """(key, baseline, baseline_rms, data, area, n_hits, saturated): samples turned over around the whole baseline, zero beyond ``length`` and
    outside hits extended by left and right; area is that of all samples before the cut. kernel: a filter that hits are sought and
    kept in; ceiling: a raw sample at or above it saturates."""

    def one(samples, baseline, n):
        inside = np.arange(len(samples)) < n
        flipped = np.where(inside, np.floor(baseline) - samples, 0.0) if baseline is not None else np.zeros(len(samples))
        sought = wf.fir_filter(flipped, kernel) if len(kernel) else flipped
        hits = wf.find_hits(sought, threshold)
        full = bool(ceiling is not None and (samples[inside] >= ceiling).any())
        return {"data": wf.keep_around_hits(sought, hits, left, right).tolist(), "area": float(flipped.sum()), "n_hits": len(hits), "saturated": full}

    rows = with_baseline(raw, baseline_samples, data, pulse)
    found = wf.with_arrays(rows, [*key, "baseline", "baseline_rms"], data, one, _RESULT, ["baseline", length])
    return found.select(*key, "baseline", "baseline_rms", "result.*")


def corrected_saturation(records: DataFrame, key: Sequence[str], group: Sequence[str], ceiling: float, before: int = 100, min_reference: float = 20.0, data: str = "data") -> DataFrame:
    """(key, result): records of one length and start per group; saturated samples follow the sum of the group's unsaturated records, scaled to
    what comes before them. The sums meet the records by a join on the group, and no group is one task's work."""
    full = F.exists(F.col(data), lambda v: v >= ceiling)
    sums = wf.sum_waveforms(records.where(~full), data, group)
    places = F.sort_array(F.collect_list(F.struct("sample", "value")))
    reference = sums.groupBy(*group).agg(F.transform(places, lambda p: p["value"].cast("double")).alias("reference"))
    rows = records.join(reference, list(group), "left")

    def one(samples, model):
        if model is None or len(model) < len(samples):
            return samples.tolist()
        return wf.correct_saturation(samples, np.asarray(model), ceiling, before, min_reference).tolist()

    return wf.with_arrays(rows, list(key), data, one, "array<double>", ["reference"])
