"""The software trigger of a veto: which pulses are kept, and what the others looked like.

One table of marked records comes out of one scan; kept pulses and the statistics of the lone ones are two filters on it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from chronofold.operators import waveform as wf
from chronofold.operators.intervals import RUN, coincidence, overlap_join
from chronofold.operators.ordered import HOUR, match
from chronofold.operators.records import with_baseline
from chronofold.session import pinned


def trigger_spans(hits: DataFrame, n: int, resolving: int, pre: int, bounds: DataFrame, by: Sequence[str] = RUN, width: int = HOUR) -> DataFrame:
    """(by, time, endtime): the n-fold coincidences, and in runs that have any the first and last ``resolving`` ns of the run, where a
    coincidence could be cut. bounds: (by, start, end) of each run."""
    spans = pinned(coincidence(hits, n, resolving, pre, by, "hit_id", width))
    edges = match(spans.groupBy(*by).agg(F.min("time").alias("a"), F.max("endtime").alias("b")), bounds, by)
    first = edges.select(*by, F.col("start").alias("time"), F.least(F.col("start") + resolving, F.col("a")).alias("endtime"))
    last = edges.select(*by, F.greatest(F.col("end") - resolving, F.col("b")).alias("time"), F.col("end").alias("endtime"))
    return spans.select(*by, "time", "endtime").unionByName(first).unionByName(last).where("time < endtime")


def record_veto(
    raw: DataFrame, threshold: float, n: int, resolving: int, pre: int, bounds: DataFrame, seconds: float = 0.0, baseline_samples: int = 26, key: str = "record_id",
    pulse: Sequence[str] = ("run_id", "channel", "pulse"), by: Sequence[str] = RUN, width: int = HOUR, observed: Observation | None = None,
) -> DataFrame:
    """raw (time, endtime, length, dt, record_i, data) with baseline, baseline_rms, area, bypassed and kept.

    Pulses that begin in the first ``seconds`` of their run are kept whole and take no part in the trigger (-1: all are). Of the others a pulse is kept, with all its
    fragments, if one of them touches a coincidence of n hits above threshold within ``resolving``, begun ``pre`` before it. A record's area is that
    of its samples around the baseline of its pulse. observed: gets the numbers of records, kept and bypassed ones of the one scan.
    """
    began = F.col("time") - F.col("record_i").cast("long") * F.size("data") * F.col("dt")
    timed = match(raw, bounds, by, "left")
    early = F.coalesce(began < F.col("start") + int(seconds * 1e9), F.lit(False)) if seconds >= 0 else F.lit(True)
    rows = with_baseline(timed.withColumn("bypassed", early), baseline_samples, "data", pulse).drop("start", "end")
    inside = F.transform("data", lambda v, i: F.when(i < F.col("length"), F.col("baseline") - v).otherwise(F.lit(0.0)))
    rows = rows.withColumn("_flipped", inside).withColumn("area", F.aggregate("_flipped", F.lit(0.0), lambda s, v: s + v))
    rows = pinned(rows)
    found = wf.hits_of(rows.where("not bypassed").select(key, *by, "time", "dt", "_flipped"), threshold, [key, *by, "time", "dt"], "_flipped")
    hits = found.select(*by, (F.col("time") + F.col("left") * F.col("dt")).alias("time"), F.struct(key, "left").alias("hit_id"))
    spans = pinned(trigger_spans(hits, n, resolving, pre, bounds, by, width))
    own = [c for c in pulse if c not in by]
    touched = overlap_join(rows.where("not bypassed").select(*by, "time", "endtime", *own), spans, by, width)
    marks = touched.select(*by, *own).distinct().withColumn("_touched", F.lit(True))
    marked = match(rows.drop("_flipped"), marks, [*by, *own], "left")
    marked = marked.withColumn("kept", F.col("bypassed") | F.coalesce("_touched", F.lit(False))).drop("_touched")
    if observed is not None:
        marked = marked.observe(observed, F.count(F.lit(1)).alias("records"), F.count_if("kept").alias("kept"), F.count_if("bypassed").alias("bypassed"))
    return marked


def lone_statistics(marked: DataFrame, by: Sequence[str] = ("run_id", "channel")) -> DataFrame:
    """Per channel of the records that are not kept: their number, that of higher fragments, and the mean area, baseline and baseline spread of first fragments,
    the summed area of the higher ones."""
    first = F.col("record_i") == 0
    mean = lambda c: F.avg(F.when(first, F.col(c)))
    return marked.where("not kept").groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_fragments"), F.count_if(~first).alias("n_higher_fragments"), mean("area").alias("mean_area"), F.coalesce(F.sum(F.when(~first, F.col("area"))), F.lit(0.0)).alias("higher_area"),
        mean("baseline").alias("mean_baseline"), mean("baseline_rms").alias("mean_baseline_rms"),
    )
