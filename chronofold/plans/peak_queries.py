"""Queries over sum waveforms, their splitting and saturation, and merged casting peaks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from chronofold.functions import numeric
from chronofold.operators import contours as ct
from chronofold.operators import neighbourhood as nb
from chronofold.operators import recorder as rec
from chronofold.operators import som as so
from chronofold.operators import splitting as sp
from chronofold.operators import sums
from chronofold.plans.interval_queries import WIDTH
from chronofold.plans.registry import query
from chronofold.session import pinned
from chronofold.sources.adapter import HITS_SQL, SECOND, WAVES_SQL, hits, waveforms

#: Records of 64 samples begin every 300 ns on the channels in turn; every 1,500 ns a peak of 900 ns begins. Example values.
DT, CHANNELS, TOP, STEP, EVERY, LENGTH = 10, 12, 7, 300, 1500, 900
_RECORDS = f"""{WAVES_SQL}, recs AS (SELECT wave_id, CAST(wave_id % {CHANNELS} AS INTEGER) AS channel, wave_id * {STEP} AS time, list_transform(data, lambda v: greatest(v, 0)) AS data FROM waves),
pk AS (SELECT DISTINCT wave_id * {STEP} // {EVERY} AS peaklet FROM waves)"""


def _records(spark, sf_dir):
    w = waveforms(spark, sf_dir)
    data = F.transform("data", lambda v: F.greatest(v, F.lit(0)).cast("int"))
    return w.select(
        F.lit("0").alias("run_id"), F.col("wave_id").alias("record_id"), (F.col("wave_id") * STEP).alias("time"), (F.col("wave_id") * STEP + F.size("data") * DT).alias("endtime"),
        (F.col("wave_id") % CHANNELS).cast("int").alias("channel"), F.lit(DT).alias("dt"), data.alias("data"), F.lit(1.0).alias("gain"), (F.array_max("data") + 0.0 * F.col("label")).alias("ceiling"),
    )


def _peaks(records):
    at = F.expr(f"time div {EVERY}L").alias("peaklet")
    return records.select("run_id", at).distinct().select("run_id", "peaklet", (F.col("peaklet") * EVERY).alias("time"), (F.col("peaklet") * EVERY + LENGTH).alias("endtime"))


def _waves(spark, sf_dir, most=50):
    r = _records(spark, sf_dir)
    return sums.peak_waveforms(_peaks(r), r.drop("ceiling"), CHANNELS, TOP, DT, most, width=10**7)


@query("peak_waveforms", f"""WITH {_RECORDS}, s AS (SELECT time + (i - 1) * {DT} AS t, channel, data[i] AS v FROM recs, range(1, 65) q(i)),
m AS (SELECT peaklet, (t - peaklet * {EVERY}) // {2 * DT} AS bin, channel, v FROM s JOIN pk ON peaklet = t // {EVERY} WHERE t < peaklet * {EVERY} + {LENGTH}),
b AS (SELECT peaklet, bin, sum(v) AS v, coalesce(sum(v) FILTER (channel < {TOP}), 0) AS top FROM m GROUP BY 1, 2),
c AS (SELECT peaklet, channel, sum(v) AS v FROM m GROUP BY 1, 2), g AS (SELECT peaklet, bin FROM pk, range({LENGTH // 2 // DT}) q(bin)), h AS (SELECT peaklet, channel FROM pk, range({CHANNELS}) q(channel)),
w AS (SELECT g.peaklet, string_agg(coalesce(v, 0)::BIGINT::VARCHAR, ',' ORDER BY g.bin) AS data, string_agg(coalesce(top, 0)::BIGINT::VARCHAR, ',' ORDER BY g.bin) AS data_top, CAST(sum(v) AS BIGINT) AS area FROM g LEFT JOIN b ON b.peaklet = g.peaklet AND b.bin = g.bin GROUP BY 1),
d AS (SELECT h.peaklet, string_agg(coalesce(v, 0)::BIGINT::VARCHAR, ',' ORDER BY h.channel) AS area_per_channel FROM h LEFT JOIN c ON c.peaklet = h.peaklet AND c.channel = h.channel GROUP BY 1)
SELECT w.peaklet, w.peaklet * {EVERY} AS time, CAST({LENGTH // 2 // DT} AS INTEGER) AS length, CAST({2 * DT} AS BIGINT) AS dt, area, data, data_top, area_per_channel FROM w JOIN d USING (peaklet)""")
def peak_waveforms(spark, sf_dir):
    """One row per peak: the waveforms of all channels and of the top ones, down-sampled, and the area of each channel."""
    joined = lambda c: F.array_join(F.transform(c, lambda v: v.cast("long").cast("string")), ",").alias(c)
    return _waves(spark, sf_dir).select("peaklet", "time", "length", "dt", F.col("area").cast("long").alias("area"), joined("data"), joined("data_top"), joined("area_per_channel"))


#: Thresholds at which the summed noise of the embeddings splits. Example values.
SPLIT_RULES = sp.SplitRules(s1=((2.0, 0.1), (6.0, 0.4)), s2=((2.0, 0.3), (6.0, 0.2)), wing=20)


@query("natural_breaks")
def natural_breaks(spark, sf_dir):
    """Peaks cut where the goodness of split exceeds the threshold of each piece's own area and rise time, over and over."""
    found = sp.split_peaklets(_waves(spark, sf_dir, 90), SPLIT_RULES)
    rounded = [F.round(c, 4).alias(c) for c in ("area", "rise_time", "range_50p_area", "range_90p_area", "width_half", "goodness", "valley_gap", "valley")]
    return found.select("peaklet", "piece", "time", "endtime", "depth", "n_maxima", *rounded)


@query("desaturated_records")
def desaturated_records(spark, sf_dir):
    """Records in peaks, of which those of channel 0 and 5 are full at three quarters of their highest sample, rebuilt from the other channels."""
    r = pinned(_records(spark, sf_dir))
    limit = F.when(F.col("channel").isin(0, 5), F.floor(F.col("ceiling") * 0.75)).otherwise(F.lit(1e9))
    clipped = r.withColumn("baseline", limit.cast("double")).withColumn("data", F.transform("data", lambda v: F.least(v, F.col("baseline").cast("int"))))
    found = sums.desaturated_records(_peaks(r), clipped, DT, 30, 5, width=10**7)
    return found.select("record_id", "area", "shift", F.array_join(F.transform("data", lambda v: v.cast("string")), ",").alias("data"))


_GAP, _NEAR = 900, 4.0


@query("merged_casting", f"""WITH RECURSIVE {HITS_SQL}, h AS (SELECT * FROM hits WHERE type = 2),
o AS (SELECT *, CASE WHEN center_time - lag(center_time) OVER w <= {_GAP * SECOND} THEN 0 ELSE 1 END AS new FROM h WINDOW w AS (PARTITION BY run_id ORDER BY center_time, hit_id)),
c AS (SELECT *, sum(new) OVER (PARTITION BY run_id ORDER BY center_time, hit_id) AS g, row_number() OVER (PARTITION BY run_id ORDER BY center_time, hit_id) AS n FROM o),
l AS (SELECT a.run_id, a.n AS a, b.n AS b FROM c a JOIN c b ON a.run_id = b.run_id AND a.g = b.g AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= {_NEAR * _NEAR}),
r AS (SELECT run_id, n AS root, n FROM c UNION SELECT r.run_id, r.root, l.b FROM r JOIN l ON l.run_id = r.run_id AND l.a = r.n),
f AS (SELECT run_id, n, min(root) AS root FROM r GROUP BY 1, 2)
SELECT run_id, min(hit_id) FILTER (c.n = root) AS hit_id, min(time) AS time, max(endtime) AS endtime, max(center_time) AS center_time, CAST(sum(area) AS BIGINT) AS area, round(sum(x * area) / sum(area), 6) AS x, round(sum(y * area) / sum(area), 6) AS y, count(*) AS n_merged
FROM c JOIN f USING (run_id, n) GROUP BY run_id, root""")
def merged_casting(spark, sf_dir):
    """Casting peaks that follow each other and are linked in the plane, through others too, as one."""
    found = nb.merge_casting(hits(spark, sf_dir).where("type = 2"), _GAP * SECOND, _NEAR, width=WIDTH)
    return found.select("run_id", "hit_id", "time", "endtime", "center_time", "area", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"), "n_merged")


def _example_som() -> so.Som:
    """A map of 6 x 5 neurons along four log times, in five colours. Example values."""
    x, y = np.meshgrid(np.arange(6.0), np.arange(5.0), indexing="ij")
    cube = np.stack([*(0.56 + 0.03 * x + 0.01 * (k - 4.5) * (y - 2) for k in range(10)), 0.77 + 0.008 * x, 0.2 * y], axis=2)
    image = np.stack([(x + y) % 5, x * 0, y * 0], axis=2)
    return so.Som(cube, image, [3.0] * 10 + [5.0, 10.0], {1: [0, 3], 2: [1], 3: [2], 0: [4]}, 90, TOP)


@query("som_classification")
def som_classification(spark, sf_dir):
    """The sum waveforms of the peaks, two in three of them of type 1 or 2, on a small map."""
    kind = (F.col("peaklet") % 3).cast("int").alias("type")
    rows = _waves(spark, sf_dir, 90).select("peaklet", kind, "area", "dt", "data", "area_per_channel")
    return so.classify(rows, _example_som(), ["peaklet"])


#: The trigger of the veto records: three hits of 250 within 100 ns, begun 50 ns before. Example values.
_TRIGGER = {"threshold": 250.0, "n": 3, "resolving": 100, "pre": 50, "seconds": 3e-6, "baseline_samples": 8}


def _raw(spark, sf_dir):
    """Waveforms as raw fragments, two to a pulse, on the channels in turn."""
    w = waveforms(spark, sf_dir)
    pulse, fragment = F.expr("wave_id div 2"), F.col("wave_id") % 2
    rows = w.select(F.lit("0").alias("run_id"), F.col("wave_id").alias("record_id"), pulse.alias("pulse"), (pulse % CHANNELS).alias("channel"), fragment.cast("int").alias("record_i"), F.lit(DT).alias("dt"),
                    (pulse * 500 + fragment * 640).alias("time"), (64 - F.col("label") % 8).cast("int").alias("length"), "data")
    return rows.withColumn("endtime", F.col("time") + F.col("length") * DT)


def _recorded(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    bounds = raw.groupBy("run_id").agg(F.min("time").alias("start"), F.max("endtime").alias("end"))
    return rec.record_veto(raw, bounds=bounds, width=10**6, **_TRIGGER)


@query("veto_recorder")
def veto_recorder(spark, sf_dir):
    """Every record with what the trigger says of it."""
    return _recorded(spark, sf_dir).select("record_id", "pulse", "channel", "bypassed", "kept", F.round("baseline", 6).alias("baseline"), F.round("area", 4).alias("area"))


@query("veto_lone_statistics")
def veto_lone_statistics(spark, sf_dir):
    found = rec.lone_statistics(pinned(_recorded(spark, sf_dir)))
    return found.select("run_id", "channel", "n_fragments", "n_higher_fragments", *[F.round(c, 4).alias(c) for c in ("mean_area", "higher_area", "mean_baseline", "mean_baseline_rms")])


def _radial(x, y, z):
    """An example change of the radius, linear along each axis, so that a grid map has it exactly."""
    return 0.1 + 0.02 * x - 0.01 * y + 0.03 * z + 0.001 * x * z


_RING = """c AS (SELECT run_id, hit_id, x + 0.37 AS x, y + 0.61 AS y, CAST(-k AS DOUBLE) AS z, 1 + k % 3 AS rad FROM hits WHERE type = 2),
q AS (SELECT *, x + rad * cos(0.1 + i * 0.7853981633974483) AS px, y + rad * sin(0.1 + i * 0.7853981633974483) AS py FROM c, range(0, 8) r(i)),
m AS (SELECT *, 1 + (0.1 + 0.02 * px - 0.01 * py + 0.03 * z + 0.001 * px * z) / sqrt(px * px + py * py) AS s, 1 + (0.1 + 0.02 * x - 0.01 * y + 0.03 * z + 0.001 * x * z) / sqrt(x * x + y * y) AS own FROM q),
n AS (SELECT *, px * s AS qx, py * s AS qy, (atan2(py, px) - atan2(y, x) + 5 * pi()) % (2 * pi()) - pi() AS off FROM m),
t AS (SELECT *, coalesce(lead(qx) OVER w, first_value(qx) OVER w) AS nx, coalesce(lead(qy) OVER w, first_value(qy) OVER w) AS ny FROM n WINDOW w AS (PARTITION BY run_id, hit_id ORDER BY i))"""


@query("event_contours", f"""WITH {HITS_SQL}, {_RING} SELECT run_id, hit_id, round(abs(sum(qx * ny - nx * qy)) / 2, 5) AS contour_area_fdc, round(any_value(x * own), 6) AS x_fdc, round(any_value(y * own), 6) AS y_fdc,
round((max(sqrt(px * px + py * py)) - min(sqrt(px * px + py * py))) / 2, 6) AS r_uncertainty, round((max(off) - min(off)) / 2, 6) AS theta_uncertainty FROM t GROUP BY run_id, hit_id""")
def event_contours(spark, sf_dir):
    """Rings around the places of the S2s, corrected by a 3-D map, and the uncertainties that they give."""
    h = hits(spark, sf_dir).where("type = 2").withColumns({"x": F.col("x") + 0.37, "y": F.col("y") + 0.61, "z": -F.col("k").cast("double"), "rad": 1 + F.col("k") % 3})
    turn = lambda i: F.lit(0.1) + i * 0.7853981633974483
    ring = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.array(F.col("x") + F.col("rad") * F.cos(turn(i)), F.col("y") + F.col("rad") * F.sin(turn(i))))
    axes = [np.linspace(-20, 20, 5), np.linspace(-20, 20, 4), np.linspace(-110, 10, 6)]
    change = numeric.GridMap(axes, _radial(*np.meshgrid(*axes, indexing="ij")))
    rows = h.withColumn("contour", ring)
    r, theta = ct.contour_uncertainty(F.col("contour"), F.col("x"), F.col("y"))
    rows = rows.withColumns({"r_uncertainty": r, "theta_uncertainty": theta})
    found = ct.correct_contours(rows, change, ["run_id", "hit_id", "r_uncertainty", "theta_uncertainty"])
    return found.select("run_id", "hit_id", F.round("contour_area_fdc", 5).alias("contour_area_fdc"), *[F.round(c, 6).alias(c) for c in ("x_fdc", "y_fdc", "r_uncertainty", "theta_uncertainty")])
