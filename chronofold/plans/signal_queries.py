"""Queries over waveforms, corrections, monitors, slow control and selections, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronofold.functions import numeric
from chronofold.operators import corrections as co
from chronofold.operators import events as ev
from chronofold.operators import intervals as iv
from chronofold.operators import merging
from chronofold.operators import monitor as mo
from chronofold.operators import patterns as pa
from chronofold.operators import slow_control as sc
from chronofold.operators import waveform as wf
from chronofold.plans.interval_queries import _BASICS, EVENTS_SQL, WIDTH, _basics, _events
from chronofold.plans.registry import query
from chronofold.session import pinned, table
from chronofold.sources.adapter import DAY, HITS_SQL, RUN_END, RUN_START, SECOND, WAVES_SQL, gains, hits, waveforms


@query("peak_basics_arrays", f"""WITH {WAVES_SQL} SELECT wave_id, len(list_filter(data, lambda v: v > 0)) AS n_channels, len(list_filter(list_slice(data, 1, 32), lambda v: v > 0)) AS top_n_channels,
list_position(data, list_max(data)) - 1 AS max_channel, list_max(data) AS max_channel_area, CAST(list_sum(data) AS BIGINT) AS area FROM waves""")
def peak_basics_arrays(spark, sf_dir):
    out = wf.peak_basics(waveforms(spark, sf_dir), "data", 32)
    return out.select("wave_id", "n_channels", "top_n_channels", "max_channel", "max_channel_area", "area")


@query("hit_pattern", f"WITH {WAVES_SQL} SELECT label, i - 1 AS sample, CAST(sum(data[i]) AS BIGINT) AS value FROM waves, range(1, 65) r(i) GROUP BY 1, 2")
def hit_pattern(spark, sf_dir):
    return wf.sum_waveforms(waveforms(spark, sf_dir), "data", ["label"])


@query("records_matrix", f"WITH {WAVES_SQL} SELECT (i - 1) // 8 AS time_bin, label AS channel, CAST(sum(data[i]) AS BIGINT) AS value FROM waves, range(1, 65) r(i) GROUP BY 1, 2")
def records_matrix(spark, sf_dir):
    return wf.records_matrix(waveforms(spark, sf_dir), 8, "data", "label")


@query("threshold_hits", f"""WITH {WAVES_SQL}, s AS (SELECT wave_id, i - 1 AS i, data[i] AS v FROM waves, range(1, 65) r(i)),
o AS (SELECT *, i - row_number() OVER (PARTITION BY wave_id ORDER BY i) AS g FROM s WHERE v >= 150)
SELECT wave_id, CAST(min(i) AS INTEGER) AS "left", CAST(max(i) + 1 AS INTEGER) AS "right", CAST(sum(v) AS DOUBLE) AS area, CAST(max(v) AS DOUBLE) AS height FROM o GROUP BY wave_id, g""")
def threshold_hits(spark, sf_dir):
    return wf.hits_of(waveforms(spark, sf_dir), 150, ["wave_id"]).drop("max_sample")


@query("som_nearest", """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
d AS (SELECT v.vec_id, r.vec_id AS ref, list_sum(list_transform(list_zip(v.e, r.e), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM v, v r WHERE r.vec_id < 16)
SELECT vec_id AS wave_id, CAST(arg_min(ref, round(d, 9) * 1000 + ref * 1e-7) AS INTEGER) AS neuron FROM d GROUP BY 1""")
def som_nearest(spark, sf_dir):
    v = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("wave_id"), F.col("embedding").cast("array<double>").alias("e"))
    refs = [r["e"] for r in v.where("wave_id < 16").orderBy("wave_id").collect()]
    return v.select("wave_id", numeric.nearest_reference(F.col("e"), refs).alias("neuron"))


@query("classify_rules", f"""WITH {HITS_SQL} SELECT hit_id, CASE WHEN k <= 80 * exp(-(area / 100.0) / 50.0) + 20 AND k <= pow(10.0, -1.0 * ((x + 10) / 20.0) + 2.0) AND k >= 2 THEN 1
WHEN NOT (k <= 80 * exp(-(area / 100.0) / 50.0) + 20 AND k <= pow(10.0, -1.0 * ((x + 10) / 20.0) + 2.0)) AND area / 100.0 >= 10 THEN 2 ELSE 0 END AS class FROM hits""")
def classify_rules(spark, sf_dir):
    h = hits(spark, sf_dir).select("hit_id", (F.col("area") / 100.0).alias("area"), F.col("k").alias("rise_time"), ((F.col("x") + 10) / 20.0).alias("area_fraction_top"), F.col("k").alias("tight_coincidence"))
    return h.select("hit_id", co.classify(h).alias("class"))


@query("pulse_counts", f"""WITH {HITS_SQL}, r AS (SELECT *, max(endtime) OVER (PARTITION BY run_id, channel ORDER BY time, hit_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach,
lead(time) OVER (PARTITION BY run_id, channel ORDER BY time, hit_id) AS nxt FROM hits), l AS (SELECT *, (reach IS NULL OR time >= reach) AND coalesce(endtime < nxt, false) AS lone FROM r)
SELECT run_id, channel, count(*) AS pulse_count, CAST(sum(area) AS BIGINT) AS pulse_area, count(*) FILTER (lone) AS lone_pulse_count, CAST(coalesce(sum(area) FILTER (lone), 0) AS BIGINT) AS lone_pulse_area,
CAST(trunc(sum(area) / CAST(count(*) AS DOUBLE)) AS BIGINT) AS mean_area FROM l GROUP BY 1, 2""")
def pulse_counts(spark, sf_dir):
    return mo.pulse_counts(hits(spark, sf_dir), width=WIDTH)


@query("online_peak_hist", f"WITH {HITS_SQL} SELECT type, CAST(least(49, floor((area - 0) / 40000.0 * 50)) AS BIGINT) AS bin, count(*) AS count FROM hits WHERE area BETWEEN 0 AND 40000 GROUP BY 1, 2")
def online_peak_hist(spark, sf_dir):
    return mo.histogram(hits(spark, sf_dir), F.col("area"), 0, 40000, 50, ["type"])


@query("online_peak_hist2d", f"""WITH {HITS_SQL} SELECT time // {DAY} AS chunk, CAST(least(19, floor(area / 40000.0 * 20)) AS BIGINT) AS bin_x, CAST(least(9, floor(k / 100.0 * 10)) AS BIGINT) AS bin_y, count(*) AS count
FROM hits WHERE area BETWEEN 0 AND 40000 AND k BETWEEN 0 AND 100 GROUP BY 1, 2, 3""")
def online_peak_hist2d(spark, sf_dir):
    return mo.histogram2d(mo.per_chunk(hits(spark, sf_dir), DAY), F.col("area"), F.col("k"), (0, 40000, 20), (0, 100, 10), ["chunk"])


@query("aft_profile", f"""WITH {HITS_SQL} SELECT CAST(least(19, floor(area / 40000.0 * 20)) AS BIGINT) AS bin_x, CAST(least(9, floor(k / 100.0 * 10)) AS BIGINT) AS bin_y, count(*) AS count, round(avg(x), 6) AS mean
FROM hits WHERE area BETWEEN 0 AND 40000 AND k BETWEEN 0 AND 100 GROUP BY 1, 2""")
def aft_profile(spark, sf_dir):
    p = mo.profile(hits(spark, sf_dir), F.col("area"), F.col("k"), F.col("x"), (0, 40000, 20), (0, 100, 10))
    return p.withColumn("mean", F.round("mean", 6))


@query("se_gain_mode", f"""WITH {HITS_SQL}, b AS (SELECT type, least(99, floor(area / 20000.0 * 100)) AS b, count(*) AS n FROM hits WHERE area BETWEEN 0 AND 20000 GROUP BY 1, 2)
SELECT type, round((b + 0.5) * 200.0, 6) AS mode FROM (SELECT *, row_number() OVER (PARTITION BY type ORDER BY n DESC, b) AS r FROM b) WHERE r = 1""")
def se_gain_mode(spark, sf_dir):
    return mo.modal_centre(hits(spark, sf_dir), F.col("area"), 0, 20000, 100, ["type"]).withColumn("mode", F.round("mode", 6))


@query("dark_rate", f"""WITH {HITS_SQL}, c AS (SELECT i AS channel FROM range(0, 160) r(i) UNION SELECT channel FROM hits WHERE channel IS NOT NULL) SELECT c.channel, round(count(h.hit_id) / 2592000.0, 9) AS dark_rate, round(sqrt(count(h.hit_id)) / 2592000.0, 9) AS dark_rate_error,
round(avg(h.area), 4) AS mean, round(stddev_pop(h.area), 4) AS deviation FROM c LEFT JOIN hits h ON h.channel = c.channel GROUP BY 1""")
def dark_rate(spark, sf_dir):
    h = hits(spark, sf_dir)
    channels = mo.channel_dimension(h, spark.range(160).select(F.col("id").alias("channel")))
    d = mo.dark_rate(h, channels, 2592000.0)
    return d.select("channel", F.round("dark_rate", 9).alias("dark_rate"), F.round("dark_rate_error", 9).alias("dark_rate_error"), F.round("mean", 4).alias("mean"), F.round("deviation", 4).alias("deviation"))


_INSIDE = f"{HITS_SQL}, {EVENTS_SQL}, ih AS (SELECT h.*, e.event_number FROM hits h JOIN evts e ON h.run_id = e.run_id AND h.time >= e.time AND h.endtime <= e.endtime)"


def _inside(spark, sf_dir):
    h, e = _events(spark, sf_dir)
    return iv.split_by_containment(h, e, "event_number", width=WIDTH)


@query("veto_event_props", f"""WITH {_INSIDE}, g AS (SELECT *, time - min(time) OVER (PARTITION BY run_id, event_number) AS t, time - lag(time) OVER (PARTITION BY run_id, event_number ORDER BY time, hit_id) AS gap FROM ih)
SELECT run_id, event_number, CAST(sum(area) AS BIGINT) AS area, count(*) AS n_hits, count(DISTINCT channel) AS n_channels, round(sum(CAST(area AS DOUBLE) * t) / sum(area) / 1e9, 4) AS center_s, min(gap) AS min_gap, max(gap) AS max_gap FROM g GROUP BY 1, 2""")
def veto_event_props(spark, sf_dir):
    p = mo.veto_event_properties(_inside(spark, sf_dir))
    return p.select("run_id", "event_number", "area", "n_hits", "n_channels", F.round(F.col("center_time") / 1e9, 4).alias("center_s"), "min_gap", "max_gap")


@query("veto_event_position", f"""WITH {_INSIDE}, f AS (SELECT * FROM (SELECT *, time - min(time) OVER (PARTITION BY run_id, event_number) AS t FROM ih) WHERE t < {900 * SECOND}),
p AS (SELECT run_id, event_number, count(*) AS n, sum(area * x) / CAST(sum(area) AS DOUBLE) AS px, sum(area * y) / CAST(sum(area) AS DOUBLE) AS py, sum(area * x * x) / CAST(sum(area) AS DOUBLE) AS xx FROM f GROUP BY 1, 2)
SELECT run_id, event_number, n AS n_prompt_hits, round(px, 6) AS pos_x, round(py, 6) AS pos_y, round(sqrt(greatest(xx - px * px, 0)), 4) AS pos_x_spread,
round(CASE WHEN atan2(py, px) < 0 THEN atan2(py, px) + 2 * pi() ELSE atan2(py, px) END, 6) AS angle FROM p""")
def veto_event_position(spark, sf_dir):
    p = mo.veto_event_position(_inside(spark, sf_dir), prompt=900 * SECOND)
    return p.select("run_id", "event_number", "n_prompt_hits", *[F.round(c, 6).alias(c) for c in ("pos_x", "pos_y", "angle")], F.round("pos_x_spread", 4).alias("pos_x_spread"))


@query("veto_area_per_channel", f"""WITH {_INSIDE}, c AS (SELECT run_id, event_number, channel, CAST(sum(area) AS BIGINT) AS a FROM ih WHERE channel IS NOT NULL GROUP BY 1, 2, 3)
SELECT run_id, event_number, channel, a AS area FROM c WHERE a <> 0""")
def veto_area_per_channel(spark, sf_dir):
    """Arrays over all channels of the table; their entries other than 0."""
    inside = pinned(_inside(spark, sf_dir))
    last = inside.agg(F.max("channel")).first()[0]
    arrays = mo.area_per_channel(inside, 1 + (last if last is not None else 0))
    return arrays.select("run_id", "event_number", F.posexplode("area_per_channel").alias("channel", "area")).where("area <> 0").withColumn("channel", F.col("channel").cast("long"))


@query("online_veto_counts", f"""WITH {_INSIDE}, n AS (SELECT run_id, event_number, count(DISTINCT channel) AS c FROM ih GROUP BY 1, 2)
SELECT run_id, count(*) FILTER (c >= 4) AS events_4coinc, count(*) FILTER (c >= 5) AS events_5coinc, count(*) FILTER (c >= 8) AS events_8coinc, count(*) FILTER (c >= 10) AS events_10coinc FROM n GROUP BY 1""")
def online_veto_counts(spark, sf_dir):
    n = _inside(spark, sf_dir).groupBy("run_id", "event_number").agg(F.countDistinct("channel").alias("n_channels"))
    return mo.online_veto_counts(n, by=["run_id"])


@query("energy_estimates", "SELECT o_orderkey, round(o_totalprice * (0.0137 / 0.15), 4) AS e_light, round(o_custkey * (0.0137 / 16.5), 6) AS e_charge, round(o_totalprice * (0.0137 / 0.15) + o_custkey * (0.0137 / 16.5), 4) AS e_ces FROM orders")
def energy_estimates(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").alias("cs1"), F.col("o_custkey").alias("cs2"))
    e = co.energy_estimates(o, 0.15, 16.5)
    return e.select("o_orderkey", F.round("e_light", 4).alias("e_light"), F.round("e_charge", 6).alias("e_charge"), F.round("e_ces", 4).alias("e_ces"))


def _as_events(h):
    """Hits as events whose main signals have the hit's area and whose alternate ones have half of it."""
    half = F.col("area") / 2.0
    aft = (F.col("x") + 10) / 20.0
    return h.select(
        "run_id", "hit_id", F.col("area").cast("double").alias("s1_area"), half.alias("alt_s1_area"), F.col("area").cast("double").alias("s2_area"), half.alias("alt_s2_area"),
        aft.alias("s2_area_fraction_top"), (aft / 2).alias("alt_s2_area_fraction_top"), F.col("x").alias("s2_x"), F.col("y").alias("s2_y"),
        (F.col("x") * 3).alias("alt_s2_x"), (F.col("y") * 3).alias("alt_s2_y"), F.col("k").alias("drift_time"), (F.col("k") * 2).alias("alt_s2_interaction_drift_time"), (-F.col("k")).alias("z"),
    )


def _cs2_sql(p: str) -> str:
    """One column for each variant and prefix, written out from the survey's order of corrections."""
    area, aft, x, y, drift = ("area", "(x + 10) / 20.0", "x", "y", "k") if not p else ("(area / 2.0)", "((x + 10) / 40.0)", "(3 * x)", "(3 * y)", "(2 * k)")
    u = f"({x} * cos(radians(30)) - {y} * sin(radians(30)))"
    factor = {
        "bias": f"(1 + {area} * 1e-6)", "xy": f"(1 + {x} / 200.0)", "segee": f"(CASE WHEN abs({u}) < 6 AND sqrt({x} * {x} + {y} * {y}) < 20 THEN 1.1 ELSE 0.9 END)", "pi": "0.95", "relcy": "1.02",
        "elife": f"exp({drift} / 650.0)",
    }
    out = []
    for v in co.CS2_VARIANTS:
        f = {n: factor[n] if d == "1" else "1.0" for n, d in zip(co.CS2_FACTORS, v)}
        top = f"({area} * {aft} / {f['bias']} / {f['xy']} / {f['segee']})"
        bottom = f"({area} * (1 - {aft}) / {f['bias']} / {f['xy']} / {f['segee']})"
        name = co.cs2_name(v)
        out.append(f"round(({top} + {bottom}) / {f['relcy']} * {f['elife']}, 3) AS {p}{name}")
        out.append(f"CASE WHEN area > 0 THEN round({top} / ({top} + {bottom} * {f['pi']}), 5) END AS {p}cs2_area_fraction_top{name[3:]}")
    return ", ".join(out)


_RLY = "(1.01 * (0.3 * 0.01 * (k * k - 2.0 * k) + 1))"


def _cs1_sql(p: str) -> str:
    area = "(area / 2.0)" if p else "area"
    f = {"peakbias": f"(1 + {area} * 1e-6)", "xyz": "(1 + 0.001 * k)", "time": _RLY}
    one = lambda skip: f"round({area} / " + " / ".join(v for k, v in f.items() if k != skip) + f", 3) AS {p}cs1" + (f"_wo_{skip}corr" if skip else "")
    return ", ".join(one(s) for s in ("", *f))


@query("corrected_areas", f"WITH {HITS_SQL} SELECT run_id, hit_id, {_cs1_sql('')}, {_cs1_sql('alt_')}, {_cs2_sql('')}, {_cs2_sql('alt_')} FROM hits WHERE type = 2")
def corrected_areas(spark, sf_dir):
    e = _as_events(hits(spark, sf_dir).where("type = 2"))
    maps = {"s1_xyz": 1 - 0.001 * F.col("z")}
    for p in ("", "alt_"):
        maps |= {f"{p}s1_bias": F.col(f"{p}s1_area") * 1e-6, f"{p}s2_bias": F.col(f"{p}s2_area") * 1e-6, f"{p}s2_xy_top": 1 + F.col(f"{p}s2_x") / 200.0, f"{p}s2_xy_bottom": 1 + F.col(f"{p}s2_x") / 200.0}
    light = co.relative_light_yield(F.col("z"), 1.01, 0.3, 2.0)
    out = co.corrected_areas(e, maps, {"ab": 1.1, "cd": 0.9}, 1.0, 1.0, 0.95, 1.02, 650.0, light, 6.0, 20.0)
    return out.select("run_id", "hit_id", *[F.round(c, 5 if "fraction" in c else 3).alias(c) for c in out.columns if c.removeprefix("alt_").startswith("cs")])


@query("peak_corrections", f"""WITH {HITS_SQL}, f AS (SELECT *, (x + 10) / 20.0 AS aft, CASE WHEN abs(x * cos(radians(30)) - y * sin(radians(30))) < 6 AND sqrt(x * x + y * y) < 20 THEN 1.1 ELSE 0.9 END AS g FROM hits WHERE area > 0)
SELECT run_id, hit_id, round(CASE WHEN type = 1 THEN area / (1 + area * 1e-6) ELSE 0 END, 3) AS cs1_wo_xyzcorr, round(CASE WHEN type = 2 THEN area / (1 + area * 2e-6) ELSE 0 END, 3) AS cs2_wo_xycorr,
CASE WHEN type = 2 THEN round(CAST(0.675 AS DOUBLE) * (2.0 - k), 6) END AS z_obs_ms, CASE WHEN type = 2 THEN round(1 / (1 + 0.001 * k), 6) END AS s1_xyz_correction_factor, CASE WHEN type = 2 THEN round(1 / 1.01, 6) END AS s1_rel_light_yield_correction_factor,
CASE WHEN type = 2 THEN round((area * aft / (1 + x / 200.0) + area * (1 - aft) / (1 + x / 300.0)) * exp(k / 650.0), 3) END AS cs2_wo_timecorr,
CASE WHEN type = 2 THEN round((area * aft / (1 + x / 200.0) + area * (1 - aft) / (1 + x / 300.0)) / g, 3) END AS cs2_wo_elifecorr,
CASE WHEN type = 2 THEN round((area * aft / (1 + x / 200.0)) / (area * aft / (1 + x / 200.0) + area * (1 - aft) / (1 + x / 300.0)), 5) END AS cs2_area_fraction_top,
CASE WHEN type = 2 THEN round((area * aft / (1 + x / 200.0) + area * (1 - aft) / (1 + x / 300.0)) / g * exp(k / 650.0), 3) END AS cs2,
CASE WHEN type = 2 THEN round(area * (1 - aft) / (1 + x / 300.0) / g * exp(k / 650.0), 3) END AS cs2_bottom FROM f""")
def peak_corrections(spark, sf_dir):
    h = hits(spark, sf_dir).where("area > 0").withColumns({"area_fraction_top": (F.col("x") + 10) / 20.0, "drift_time": F.col("k")})
    maps = {"s1_bias": F.col("area") * 1e-6, "s2_bias": F.col("area") * 2e-6, "s1_xyz": 1 + 0.001 * F.col("k"), "s2_xy_top": 1 + F.col("x") / 200.0, "s2_xy_bottom": 1 + F.col("x") / 300.0}
    out = co.peak_corrections(h, maps, {"ab": 1.1, "cd": 0.9}, 1.0, 1.0, 650.0, 0.675, 2.0, 1.01, 6.0, 20.0)
    digits = {"cs2_area_fraction_top": 5, "z_obs_ms": 6, "s1_xyz_correction_factor": 6, "s1_rel_light_yield_correction_factor": 6}
    names = ["cs1_wo_xyzcorr", "cs2_wo_xycorr", "cs2_wo_timecorr", "cs2_wo_elifecorr", "cs2", "cs2_bottom", *digits]
    return out.select("run_id", "hit_id", *[F.round(c, digits.get(c, 3)).alias(c) for c in names])


@query("split_threshold", f"""WITH {HITS_SQL}, m AS (SELECT *, 1 / (1 + exp(-8 * log10(least(greatest(k * 10.0, 1), 1e5) / 100))) AS s, log10(least(greatest(area, 1), 1e7)) AS a FROM hits)
SELECT run_id, hit_id, round(s * CASE WHEN a <= 2 THEN 0.9 WHEN a <= 4 THEN 0.9 - 0.2 * (a - 2) ELSE 0.5 END + (1 - s) * CASE WHEN a <= 1 THEN 0.4 WHEN a <= 5 THEN 0.4 + 0.1 * (a - 1) ELSE 0.8 END, 6) AS threshold FROM m""")
def split_threshold(spark, sf_dir):
    t = wf.split_threshold(F.col("k") * 10.0, F.col("area"), ((1, 0.4), (5, 0.8)), ((2, 0.9), (4, 0.5)))
    return hits(spark, sf_dir).select("run_id", "hit_id", F.round(t, 6).alias("threshold"))


@query("event_positions", f"""WITH {HITS_SQL} SELECT hit_id, round(sqrt(x * x + y * y) + 0.01 * k, 6) AS r, round(CAST(-0.675 AS DOUBLE) * k - CAST(1.5 AS DOUBLE), 6) AS z,
round(CASE WHEN x = 0 AND y = 0 THEN 0.0 ELSE x * (sqrt(x * x + y * y) + 0.01 * k) / sqrt(x * x + y * y) END, 6) AS x_corrected FROM hits""")
def event_positions(spark, sf_dir):
    h = hits(spark, sf_dir).select("hit_id", "x", "y", F.col("k").alias("drift_time"), (F.col("k") * 0.01).alias("r_correction"))
    p = co.event_positions(h, 0.675, -1.5)
    return p.select("hit_id", *[F.round(c, 6).alias(c) for c in ("r", "z", "x_corrected")])


@query("wire_region", f"""WITH {HITS_SQL} SELECT hit_id, abs(x * cos(radians(30)) - y * sin(radians(30))) < 6.0 AND sqrt(x * x + y * y) < 8.0 AS near_wires FROM hits""")
def wire_region(spark, sf_dir):
    return hits(spark, sf_dir).select("hit_id", co.near_wires(F.col("x"), F.col("y"), 6.0, 8.0).alias("near_wires"))


@query("idw_map", """WITH e AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS a, CAST(embedding[2] AS DOUBLE) AS b, CAST(embedding[3] AS DOUBLE) AS v FROM embeddings),
q AS (SELECT p.vec_id, m.v, greatest(sqrt((p.a - m.a) ** 2 + (p.b - m.b) ** 2), 1e-6) AS d, row_number() OVER (PARTITION BY p.vec_id ORDER BY sqrt((p.a - m.a) ** 2 + (p.b - m.b) ** 2), m.vec_id) AS r FROM e p, e m WHERE m.vec_id < 100)
SELECT vec_id, round(sum(v / d) / sum(1 / d), 6) AS value FROM q WHERE r <= 4 GROUP BY 1""")
def idw_map(spark, sf_dir):
    """All rows, looked up in a map of 100 points: they stand for a calibration map, whose size does not grow with the data."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate("abv")])
    points = e.where("vec_id < 100").orderBy("vec_id").toPandas()
    m = numeric.NearestMap(points[["a", "b"]].to_numpy(), points["v"].to_numpy())
    return numeric.apply_map(e, m, ["a", "b"], "value").select("vec_id", F.round("value", 6).alias("value"))


@query("piecewise_threshold", f"WITH {HITS_SQL} SELECT hit_id, round(CASE WHEN k <= 10 THEN 1.0 WHEN k <= 40 THEN 1.0 + (k - 10) / 15.0 WHEN k <= 80 THEN 3.0 - (k - 40) * 0.05 ELSE 1.0 END, 6) AS threshold FROM hits")
def piecewise_threshold(spark, sf_dir):
    return hits(spark, sf_dir).select("hit_id", F.round(numeric.piecewise_linear(F.col("k"), [10, 40, 80], [1, 3, 1]), 6).alias("threshold"))


@query("poisson_pmf", f"WITH {HITS_SQL} SELECT hit_id, round(exp(k * ln(30.0) - 30.0 - lgamma(k + 1)), 9) AS p FROM hits")
def poisson_pmf(spark, sf_dir):
    return hits(spark, sf_dir).select("hit_id", F.round(numeric.poisson_pmf(F.col("k"), F.lit(30.0)), 9).alias("p"))


HOUR = 3600 * SECOND
_CAL = f"cal AS (SELECT rr.run_id, {RUN_START} + i * CAST({HOUR} AS BIGINT) AS time FROM range(0, {(RUN_END - RUN_START) // HOUR} + 1) r(i), (SELECT DISTINCT run_id FROM hits WHERE type = 3) rr), pts AS (SELECT run_id AS pr, time AS pt, CAST(area AS DOUBLE) AS v FROM hits WHERE type = 3)"


def _series(spark, sf_dir):
    return hits(spark, sf_dir).where("type = 3").select("run_id", "time", F.col("area").alias("value"))


@query("scada_fill_ffill", f"WITH {HITS_SQL}, {_CAL} SELECT cal.run_id, cal.time, p.v AS value FROM cal ASOF LEFT JOIN pts p ON cal.run_id = p.pr AND cal.time >= p.pt")
def scada_fill_ffill(spark, sf_dir):
    return sc.fill(_series(spark, sf_dir), RUN_START, RUN_END, HOUR, width=WIDTH).select("run_id", "time", "value")


@query("scada_fill_linear", f"""WITH {HITS_SQL}, {_CAL} SELECT cal.run_id, cal.time, round(CASE WHEN a.pt = b.pt THEN a.v ELSE a.v + (b.v - a.v) * ((cal.time - a.pt) / CAST(b.pt - a.pt AS DOUBLE)) END, 4) AS value
FROM cal ASOF LEFT JOIN pts a ON cal.run_id = a.pr AND cal.time >= a.pt ASOF LEFT JOIN pts b ON cal.run_id = b.pr AND cal.time <= b.pt""")
def scada_fill_linear(spark, sf_dir):
    out = sc.fill(_series(spark, sf_dir), RUN_START, RUN_END, HOUR, "interpolate", width=WIDTH)
    return out.select("run_id", "time", F.round("value", 4).alias("value"))


@query("scada_average_n", f"""WITH {HITS_SQL}, n AS (SELECT run_id, time, area, (row_number() OVER (PARTITION BY run_id ORDER BY time) - 1) // 7 AS bin, count(*) OVER (PARTITION BY run_id) AS n FROM hits WHERE type = 3)
SELECT run_id, bin, min(time) AS time, round(avg(area), 6) AS value FROM n WHERE bin < n // 7 - CASE WHEN n % 7 = 0 THEN 0 ELSE 1 END GROUP BY 1, 2""")
def scada_average_n(spark, sf_dir):
    return sc.average_every(_series(spark, sf_dir), 7, width=WIDTH).select("run_id", "bin", "time", F.round("value", 6).alias("value"))


@query("gps_interpolate", f"""WITH {HITS_SQL}, s AS (SELECT run_id AS sr, time AS st, time + 5000 + k AS truth FROM hits WHERE type = 3), q AS (SELECT run_id, hit_id, time FROM hits WHERE type = 1)
SELECT q.run_id, q.hit_id, a.truth + CASE WHEN a.st = b.st THEN 0 ELSE CAST(trunc(((q.time - a.st) / CAST(b.st - a.st AS DOUBLE)) * (b.truth - a.truth)) AS BIGINT) END AS synced
FROM q ASOF LEFT JOIN s a ON q.run_id = a.sr AND q.time >= a.st ASOF LEFT JOIN s b ON q.run_id = b.sr AND q.time <= b.st""")
def gps_interpolate(spark, sf_dir):
    return _synced(spark, sf_dir, extrapolate=False)


def _synced(spark, sf_dir, extrapolate):
    h = hits(spark, sf_dir)
    s = h.where("type = 3").select("run_id", "time", (F.col("time") + 5000 + F.col("k")).alias("truth"))
    return sc.interpolate_clock(h.where("type = 1"), s, "hit_id", width=WIDTH, extrapolate=extrapolate)


@query("gps_extrapolate", f"""WITH {HITS_SQL}, s AS (SELECT *, lag(st) OVER w AS pt, lag(truth) OVER w AS pg, lead(st) OVER w AS nt, lead(truth) OVER w AS ng
FROM (SELECT run_id AS sr, time AS st, max(time + 5000 + k) AS truth FROM hits WHERE type = 3 GROUP BY 1, 2) WINDOW w AS (PARTITION BY sr ORDER BY st)), q AS (SELECT run_id, hit_id, time FROM hits WHERE type = 1),
e AS (SELECT q.run_id, q.hit_id, q.time, CASE WHEN b.st IS NULL THEN a.pt WHEN a.st IS NULL THEN b.st ELSE a.st END AS t0, CASE WHEN b.st IS NULL THEN a.pg WHEN a.st IS NULL THEN b.truth ELSE a.truth END AS g0,
CASE WHEN b.st IS NULL THEN a.st WHEN a.st IS NULL THEN b.nt ELSE b.st END AS t1, CASE WHEN b.st IS NULL THEN a.truth WHEN a.st IS NULL THEN b.ng ELSE b.truth END AS g1
FROM q ASOF LEFT JOIN s a ON q.run_id = a.sr AND q.time >= a.st ASOF LEFT JOIN s b ON q.run_id = b.sr AND q.time <= b.st)
SELECT run_id, hit_id, g0 + CASE WHEN t0 = t1 THEN 0 ELSE CAST(trunc(((time - t0) / CAST(t1 - t0 AS DOUBLE)) * (g1 - g0)) AS BIGINT) END AS synced FROM e""")
def gps_extrapolate(spark, sf_dir):
    return _synced(spark, sf_dir, extrapolate=True)


@query("pulse_assemble", "SELECT conv_id, string_agg(text, '' ORDER BY turn) AS text FROM conversations GROUP BY 1")
def pulse_assemble(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("record_i"), F.array("text").alias("data"))
    return wf.assemble_pulses(c, ["conv_id"]).select("conv_id", F.array_join("data", "").alias("text"))


@query("latest_comment", "SELECT conv_id, arg_max(text, turn) AS comment FROM conversations GROUP BY 1")
def latest_comment(spark, sf_dir):
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.max_by("text", "turn").alias("comment"))


@query("run_doc_path", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def run_doc_path(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


@query("run_selection", "SELECT c_custkey FROM customer c WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 100000) AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def run_selection(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey")
    return c.join(o.where("o_totalprice > 100000"), "c_custkey", "left_semi").join(o.where("o_orderstatus = 'P'"), "c_custkey", "left_anti")


@query("replace_merged", f"""WITH {HITS_SQL}, {EVENTS_SQL} SELECT run_id, hit_id AS id, time, endtime, false AS merged FROM hits h WHERE type = 1 OR NOT EXISTS (SELECT 1 FROM evts e WHERE e.run_id = h.run_id AND h.time >= e.time AND h.endtime <= e.endtime)
UNION ALL SELECT run_id, event_number, time, endtime, true FROM evts""")
def replace_merged(spark, sf_dir):
    h, e = _events(spark, sf_dir)
    merged = e.select("run_id", "time", "endtime", F.col("event_number").alias("hit_id"), F.lit(2).alias("type"))
    out = merging.replace_merged(h.select("run_id", "time", "endtime", "hit_id", "type"), merged, width=WIDTH)
    return out.select("run_id", F.col("hit_id").alias("id"), "time", "endtime", "merged")


@query("superrun_union", f"WITH {HITS_SQL} SELECT hit_id, time // (10 * {DAY}) AS sub_run FROM hits")
def superrun_union(spark, sf_dir):
    from chronofold.plans.engine import superrun

    h = hits(spark, sf_dir).withColumn("sub_run", F.expr(f"time div {10 * DAY}"))
    found = sorted(r[0] for r in h.select("sub_run").distinct().collect())
    parts = {str(i): (h.where(F.col("sub_run") == i), "same") for i in found}
    return superrun("_all", parts).select("hit_id", "sub_run")


@query("lifetime", f"WITH {HITS_SQL} SELECT run_id, max(endtime) - min(time) AS lifetime FROM hits GROUP BY 1")
def lifetime(spark, sf_dir):
    return hits(spark, sf_dir).groupBy("run_id").agg((F.max("endtime") - F.min("time")).alias("lifetime"))


@query("gain_lookup", f"WITH {HITS_SQL} SELECT channel, CAST(sum(area * CASE WHEN channel % 17 = 0 THEN 0 ELSE 1 + channel % 3 END) AS BIGINT) AS pe FROM hits GROUP BY 1")
def gain_lookup(spark, sf_dir):
    h = hits(spark, sf_dir)
    return h.join(gains(h), "channel").groupBy("channel").agg(F.sum(F.col("area") * F.col("gain")).alias("pe"))


@query("orders_with_items", "SELECT o_orderkey, count(*) AS n_items, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT) * CAST(round((1 - l_discount) * 100) AS BIGINT)) AS BIGINT) AS revenue_e4 FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F' GROUP BY 1")
def orders_with_items(spark, sf_dir):
    o = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select("o_orderkey")
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_extendedprice", "l_discount")
    return o.join(li, "o_orderkey").groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n_items"), F.sum(F.round(F.col("l_extendedprice") * 100).cast("long") * F.round((1 - F.col("l_discount")) * 100).cast("long")).alias("revenue_e4"))


@query("role_attach", f"""WITH b AS ({_BASICS}), {HITS_SQL} SELECT b.run_id, b.event_number, s1.channel AS s1_channel, s2.channel AS s2_channel, a1.channel AS alt_s1_channel, a2.channel AS alt_s2_channel, s2.k AS s2_k
FROM b LEFT JOIN hits s1 ON s1.run_id = b.run_id AND s1.hit_id = b.s1_id LEFT JOIN hits s2 ON s2.run_id = b.run_id AND s2.hit_id = b.s2_id
LEFT JOIN hits a1 ON a1.run_id = b.run_id AND a1.hit_id = b.alt_s1_id LEFT JOIN hits a2 ON a2.run_id = b.run_id AND a2.hit_id = b.alt_s2_id""")
def role_attach(spark, sf_dir):
    h = hits(spark, sf_dir).select("run_id", "hit_id", "channel", "k")
    return ev.attach_by_role(_basics(spark, sf_dir), h, ["channel", "k"]).select("run_id", "event_number", "s1_channel", "s2_channel", "alt_s1_channel", "alt_s2_channel", "s2_k")


def _positive(spark, sf_dir):
    return waveforms(spark, sf_dir).withColumn("data", F.transform("data", lambda v: F.greatest(v, F.lit(0))))


@query("waveform_widths", f"""WITH {WAVES_SQL}, s AS (SELECT wave_id, i - 1 AS i, CAST(greatest(data[i], 0) AS DOUBLE) AS v FROM waves, range(1, 65) r(i)),
c AS (SELECT *, sum(v) OVER (PARTITION BY wave_id ORDER BY i) AS hi, sum(v) OVER (PARTITION BY wave_id) AS whole FROM s),
q AS (SELECT wave_id, f, i, i + CASE WHEN v > 0 THEN (f / 20.0 * whole - (hi - v)) / v ELSE 0 END AS pos FROM c, range(0, 21) q(f) WHERE whole > 0 AND hi > f / 20.0 * whole),
t AS (SELECT wave_id, f, arg_min(pos, i) AS pos FROM q GROUP BY 1, 2),
p AS (SELECT w.wave_id, max(pos) FILTER (f = 5) AS a5, max(pos) FILTER (f = 15) AS a15, max(pos) FILTER (f = 1) AS a1, max(pos) FILTER (f = 19) AS a19 FROM waves w LEFT JOIN t ON t.wave_id = w.wave_id GROUP BY 1)
SELECT wave_id, round(coalesce(a15 - a5, 0), 9) AS range_50p, round(coalesce(a19 - a1, 0), 9) AS range_90p FROM p""")
def waveform_widths(spark, sf_dir):
    found = wf.with_arrays(_positive(spark, sf_dir), ["wave_id"], "data", lambda d: wf.widths(d)[0].tolist(), "array<double>")
    return found.select("wave_id", F.round(F.get("result", F.lit(5)), 9).alias("range_50p"), F.round(F.get("result", F.lit(9)), 9).alias("range_90p"))


_FIT = """round(sum(CASE WHEN mu > 0 AND n > 0 THEN 2 * (mu - n + n * ln(n / mu)) ELSE 0 END), 4)"""


@query("pattern_fit", f"""WITH {WAVES_SQL}, s AS (SELECT wave_id, label, i - 1 AS i, CAST(abs(data[i]) AS DOUBLE) AS o, CAST(1 + (i - 1 + label) % 5 AS DOUBLE) AS e FROM waves, range(1, 65) r(i)),
t AS (SELECT *, sum(o) OVER w AS area, sum(o) FILTER (i < 40) OVER w AS top FROM s WINDOW w AS (PARTITION BY wave_id)), l AS (SELECT * FROM t WHERE i % 13 <> 0 AND area > 500),
a AS (SELECT wave_id, e * area / sum(e) OVER (PARTITION BY wave_id) / 1.2 AS mu, o / 1.2 AS n FROM l), b AS (SELECT wave_id, i < 40 AS up, e * CASE WHEN i < 40 THEN top ELSE area - top END / sum(e) OVER (PARTITION BY wave_id, i < 40) / 1.2 AS mu, o / 1.2 AS n FROM l),
x AS (SELECT wave_id, {_FIT} AS v FROM a GROUP BY 1), y AS (SELECT wave_id, up, {_FIT} AS v FROM b GROUP BY 1, 2)
SELECT w.wave_id, x.v AS two_nll, u.v AS two_nll_top, d.v AS two_nll_bottom FROM waves w LEFT JOIN x ON x.wave_id = w.wave_id LEFT JOIN y u ON u.wave_id = w.wave_id AND u.up LEFT JOIN y d ON d.wave_id = w.wave_id AND NOT d.up""")
def pattern_fit(spark, sf_dir):
    """Patterns against a map that depends on the label, every 13th channel dead, 1.2 units of area a photon."""
    w = waveforms(spark, sf_dir).withColumn("observed", F.transform("data", lambda v: F.abs(v)))
    w = w.withColumns({"area": wf.total(F.col("observed")), "top": wf.total(F.slice("observed", 1, 40)), "efficiency": F.transform("data", lambda v, i: (1 + (i + F.col("label")) % 5).cast("double"))})
    fit = pa.pattern_fit(w.withColumn("aft", F.try_divide(F.col("top"), F.col("area"))), 40, [i % 13 != 0 for i in range(64)], 1.2, 500, observed="observed", aft="aft")
    return fit.select("wave_id", *[F.round(c, 4).alias(c) for c in ("two_nll", "two_nll_top", "two_nll_bottom")])


@query("aft_probabilities", None)
def aft_probabilities(spark, sf_dir):
    """Area fractions top of the hits, as S1s, under an expected one that depends on the place."""
    h = hits(spark, sf_dir).where("type = 1").select("run_id", "hit_id", (F.col("area") / 100.0).alias("area"), (F.col("k") / 100.0).alias("aft"), (0.3 + F.col("y") * 0.05).alias("expected"))
    return pa.aft_probabilities(h, ["run_id", "hit_id"], "expected", "area", "aft", 1.2)


@query("led_calibration", f"""WITH {WAVES_SQL}, b AS (SELECT wave_id, label, data, list_avg(data[1:30]) AS b, list_stddev_pop(data[1:30]) AS s FROM waves),
n AS (SELECT *, list_transform(data, lambda x: b - x) AS d FROM b), r AS (SELECT wave_id, min(i - 1) AS hit FROM n, range(31, 65) q(i) WHERE d[i] >= 2 * s AND d[i - 1] < 2 * s GROUP BY 1),
m AS (SELECT label, hit AS mode FROM (SELECT label, hit, row_number() OVER (PARTITION BY label ORDER BY count(*) DESC, hit) AS k FROM r JOIN n USING (wave_id) GROUP BY label, hit) WHERE k = 1),
w AS (SELECT n.*, r.hit IS NOT NULL AS triggered, CAST(CASE WHEN r.hit IS NOT NULL THEN least(r.hit, 50) WHEN m.mode IS NOT NULL THEN least(m.mode, 50) ELSE 40 END AS INTEGER) AS pos FROM n LEFT JOIN r USING (wave_id) LEFT JOIN m USING (label))
SELECT wave_id, triggered, pos AS hit_position, round(list_max(d[pos - 1:pos + 8]), 6) AS amplitude_led, round(list_max(d[1:10]), 6) AS amplitude_noise, round((list_sum(d[pos - 1:pos + 8]) + list_sum(d[pos - 1:pos + 11]) + list_sum(d[pos - 1:pos + 14])) / 3, 6) AS area FROM w""")
def led_calibration(spark, sf_dir):
    """Waveforms as calibration records, grouped by label: turned over, windows around the first hit, light in them."""
    rows = pa.led_records(waveforms(spark, sf_dir).withColumn("record_i", F.lit(0)), 64, (0, 30))
    light = pa.led_light(pa.led_windows(rows, 2.0, (-2, 8), 30, 40, 64, 6, by=["label"]), (0, 10), 6, 3)
    return light.select("wave_id", "triggered", "hit_position", *[F.round(c, 6).alias(c) for c in ("amplitude_led", "amplitude_noise", "area")])


@query("afterpulses", None)
def afterpulses(spark, sf_dir):
    def kernel(d):
        found = wf.find_afterpulses([h[:2] for h in wf.find_hits(d, 150)], (0, 20))
        return [dict(zip(("left", "right", "tdelay"), a)) for a in found]

    found = wf.with_arrays(waveforms(spark, sf_dir), ["wave_id"], "data", kernel, "array<struct<left:int,right:int,tdelay:int>>")
    return found.select("wave_id", F.explode("result").alias("a")).select("wave_id", "a.*")


@query("sample_monitor", None)
def sample_monitor(spark, sf_dir):
    h = hits(spark, sf_dir).select("hit_id", "time", "area")
    return mo.sample_to_budget(h, 24, 24_000, "hit_id", h.count())
