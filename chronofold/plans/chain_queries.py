"""Queries over peaklets, veto events, selections and small projections, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronofold.operators import intervals as iv
from chronofold.operators import merging as mg
from chronofold.operators import monitor as mo
from chronofold.operators import peaklets as pk
from chronofold.operators import posterior as po
from chronofold.operators import records as rc
from chronofold.operators import selections as se
from chronofold.operators import waveform as wf
from chronofold.plans.interval_queries import _MERGED, EVENTS_SQL, RESOLVING, WIDTH, _coincidence_sql, _events
from chronofold.plans.registry import query
from chronofold.session import pinned, table
from chronofold.sources.adapter import DAY, HITS_SQL, RUN_END, RUN_START, SECOND, WAVES_SQL, hits, waveforms

GAP, LEFT, RIGHT = 400 * SECOND, 30 * SECOND, 60 * SECOND
_PEAKLETS = f"""pm AS (SELECT *, CASE WHEN time - max(endtime) OVER (PARTITION BY run_id ORDER BY time, hit_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= {GAP} THEN 0 ELSE 1 END AS new FROM hits),
pg AS (SELECT *, sum(new) OVER (PARTITION BY run_id ORDER BY time, hit_id) AS g FROM pm),
pc AS (SELECT run_id, min(time) - {LEFT} AS time, max(endtime) + {RIGHT} AS endtime, count(*) AS n_hits, count(DISTINCT channel) AS n_channels, CAST(sum(area) AS BIGINT) AS area FROM pg GROUP BY run_id, g HAVING count(DISTINCT channel) >= 2),
peaklets AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY time) - 1 AS peaklet FROM pc)"""


def _peaklets(spark, sf_dir):
    h = hits(spark, sf_dir)
    return h, pk.find_peaklets(h, GAP, LEFT, RIGHT, 2, width=WIDTH)


@query("peaklets", f"WITH {HITS_SQL}, {_PEAKLETS} SELECT run_id, peaklet, time, endtime, n_hits, n_channels, area FROM peaklets")
def peaklets(spark, sf_dir):
    return _peaklets(spark, sf_dir)[1].select("run_id", "peaklet", "time", "endtime", "n_hits", "n_channels", "area")


@query("hit_features", f"""WITH {HITS_SQL}, {_PEAKLETS}, i AS (SELECT p.run_id, p.peaklet, h.center_time, h.hit_id, h.channel FROM peaklets p JOIN hits h ON h.run_id = p.run_id AND h.time >= p.time AND h.endtime <= p.endtime),
g AS (SELECT *, center_time - lag(center_time) OVER w AS gap, row_number() OVER w AS r, count(*) OVER (PARTITION BY run_id, peaklet) AS n FROM i WINDOW w AS (PARTITION BY run_id, peaklet ORDER BY center_time, hit_id))
SELECT p.run_id, p.peaklet, coalesce(max(gap), -1) AS max_diff, coalesce(min(gap), -1) AS min_diff, coalesce(max(channel) FILTER (r = 1), -1) AS first_channel, coalesce(max(channel) FILTER (r = n), -1) AS last_channel
FROM peaklets p LEFT JOIN g ON g.run_id = p.run_id AND g.peaklet = p.peaklet GROUP BY 1, 2""")
def hit_features(spark, sf_dir):
    h, p = _peaklets(spark, sf_dir)
    return pk.hit_features(p, h, width=WIDTH)


DT = 60 * SECOND


@query("peaklet_waveform", f"""WITH {HITS_SQL}, {_PEAKLETS}, s AS (SELECT run_id, time, time + i * {DT} AS at, area // (i + 1) AS v FROM hits, range(0, 4) r(i))
SELECT p.run_id, p.peaklet, CAST((s.at - p.time) // {DT} AS BIGINT) AS sample, CAST(sum(s.v) AS BIGINT) AS value FROM peaklets p JOIN s ON s.run_id = p.run_id AND s.time >= p.time AND s.time <= p.endtime AND s.at < p.endtime GROUP BY 1, 2, 3""")
def peaklet_waveform(spark, sf_dir):
    """Hits as four samples of a falling pulse, summed at their places in the peaklets."""
    h, p = _peaklets(spark, sf_dir)
    pulses = h.withColumn("data", F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.call_function("div", F.col("area"), i + 1)))
    return pk.sum_waveform(p, pulses, DT, width=WIDTH)


@query("integration_bounds", f"""WITH {HITS_SQL}, n AS (SELECT *, lag(endtime) OVER w AS pe, lead(time) OVER w AS nt FROM hits WINDOW w AS (PARTITION BY run_id, channel ORDER BY time, hit_id))
SELECT run_id, hit_id, greatest(time - {GAP}, coalesce(least(pe + {DAY}, time), time - {GAP}), {RUN_START}) AS left_bound, least(endtime + {DAY}, greatest(coalesce(nt, endtime + {DAY}), endtime), {RUN_END}) AS right_bound FROM n""")
def integration_bounds(spark, sf_dir):
    b = pk.integration_bounds(hits(spark, sf_dir), GAP, DAY, width=WIDTH, lowest=RUN_START, highest=RUN_END)
    return b.select("run_id", "hit_id", "left_bound", "right_bound")


@query("hitlet_areas", f"""WITH {WAVES_SQL}, s AS (SELECT wave_id, data, i - 1 AS i, data[i] AS v FROM waves, range(1, 65) r(i)),
o AS (SELECT *, i - row_number() OVER (PARTITION BY wave_id ORDER BY i) AS g FROM s WHERE v >= 150),
h AS (SELECT wave_id, any_value(data) AS data, min(i) AS l, max(i) + 1 AS r FROM o GROUP BY wave_id, g),
b AS (SELECT *, lag(r) OVER w AS pr, lead(l) OVER w AS nl FROM h WINDOW w AS (PARTITION BY wave_id ORDER BY l)),
c AS (SELECT wave_id, data, greatest(l - 3, coalesce(least(pr + 5, l), l - 3), 0) AS a, least(r + 5, greatest(coalesce(nl, r + 5), r), 64) AS z FROM b)
SELECT wave_id, CAST(a AS BIGINT) AS left_bound, CAST(z AS BIGINT) AS right_bound, CAST(list_sum(list_slice(data, a + 1, z)) AS BIGINT) AS integral FROM c""")
def hitlet_areas(spark, sf_dir):
    """Threshold hits extended within their waveform, limited by their neighbours, and integrated."""
    w = waveforms(spark, sf_dir)
    found = wf.hits_of(w, 150, ["wave_id"]).select("wave_id", F.col("left").cast("long").alias("time"), F.col("right").cast("long").alias("endtime"), F.col("left").cast("long").alias("hit_id"))
    bounds = pk.integration_bounds(found, 3, 5, ("wave_id",), width=64, lowest=0, highest=64)
    return pk.integrate(bounds.join(w, "wave_id"), "data", "left_bound", "right_bound").select("wave_id", "left_bound", "right_bound", "integral")


@query("veto_events", f"""WITH {HITS_SQL}, {_coincidence_sql(4)}, nh AS (SELECT run_id, time, endtime, row_number() OVER (PARTITION BY run_id ORDER BY time, hit_id) - 1 AS place FROM hits),
r AS (SELECT c.run_id, min(place) AS a, max(place) + 1 AS b FROM coin c JOIN nh ON nh.run_id = c.run_id AND nh.time < c.endtime AND c.time < nh.endtime GROUP BY c.run_id, c.time),
m AS (SELECT *, CASE WHEN a < max(b) OVER (PARTITION BY run_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM r),
g AS (SELECT run_id, min(a) AS a, max(b) AS b FROM (SELECT *, sum(new) OVER (PARTITION BY run_id ORDER BY a, b) AS g FROM m) GROUP BY run_id, g),
e AS (SELECT g.run_id, g.a, min(nh.time) AS time, max(nh.endtime) AS endtime, count(*) AS n_hits FROM g JOIN nh ON nh.run_id = g.run_id AND nh.place >= g.a AND nh.place < g.b GROUP BY 1, 2)
SELECT run_id, row_number() OVER (PARTITION BY run_id ORDER BY time) - 1 AS event_number, time, endtime, n_hits FROM e""")
def veto_events(spark, sf_dir):
    return pk.veto_events(hits(spark, sf_dir), 4, RESOLVING, SECOND, width=WIDTH)


@query("lone_record_stats", f"""WITH {HITS_SQL} SELECT run_id, channel, count(*) FILTER (k % 3 = 0) AS n_lone, count(*) FILTER (k % 3 <> 0) AS n_fragments, round(avg(area) FILTER (k % 3 = 0), 6) AS mean_area,
round(avg(x) FILTER (k % 3 = 0), 6) AS mean_baseline FROM hits GROUP BY 1, 2""")
def lone_record_stats(spark, sf_dir):
    s = pk.lone_record_statistics(hits(spark, sf_dir).withColumns({"record_i": F.col("k") % 3, "baseline": F.col("x")}))
    return s.withColumns({c: F.round(c, 6) for c in ("mean_area", "mean_baseline")})


@query("pulse_delay", f"""WITH {HITS_SQL}, mk AS (SELECT run_id, channel, time, endtime, CASE WHEN time <= max(endtime) OVER (PARTITION BY run_id, channel ORDER BY time, endtime ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM hits),
p AS (SELECT run_id, channel, min(time) AS time, max(endtime) AS endtime FROM (SELECT *, sum(new) OVER (PARTITION BY run_id, channel ORDER BY time, endtime) AS g FROM mk) GROUP BY run_id, channel, g)
SELECT h.run_id, h.channel, h.hit_id, p.time AS pulse, h.center_time - p.time AS delta_time FROM hits h JOIN p ON p.run_id = h.run_id AND p.channel = h.channel AND h.time >= p.time AND h.endtime <= p.endtime""")
def pulse_delay(spark, sf_dir):
    h = hits(spark, sf_dir)
    pulses = iv.merge_intervals(h, ("run_id", "channel"), WIDTH)
    return pk.pulse_delay(h, pulses, width=WIDTH)


NEAR = int(4.5 * SECOND) * 40


@query("gps_match", f"WITH {HITS_SQL} SELECT p.run_id, p.hit_id, t.time AS truth FROM hits p JOIN hits t ON t.run_id = p.run_id AND t.type = 3 AND t.time BETWEEN p.time - {NEAR} AND p.time + {NEAR} WHERE p.type = 1")
def gps_match(spark, sf_dir):
    h = hits(spark, sf_dir)
    return pk.match_clock(h.where("type = 1"), h.where("type = 3").select("run_id", F.col("time").alias("truth")), NEAR, NEAR, width=WIDTH)


_REGIONS = f"""bg AS (SELECT run_id, time, time + {DAY // 4} AS endtime FROM hits WHERE type = 2 AND area > 12000),
bm AS (SELECT *, CASE WHEN time <= max(endtime) OVER (PARTITION BY run_id ORDER BY time, endtime ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM bg),
rg AS (SELECT run_id, min(time) AS time, max(endtime) AS endtime FROM (SELECT *, sum(new) OVER (PARTITION BY run_id ORDER BY time, endtime) AS g FROM bm) GROUP BY run_id, g),
rs AS (SELECT rg.run_id, rg.time AS region, CAST((h.time - rg.time) // {1800 * SECOND} AS BIGINT) AS bin, CAST(sum(h.area) AS BIGINT) AS area FROM rg JOIN hits h ON h.run_id = rg.run_id AND h.time >= rg.time AND h.time < rg.endtime GROUP BY 1, 2, 3)"""


@query("rough_sum", f"WITH {HITS_SQL}, {_REGIONS} SELECT run_id, region, bin, area FROM rs")
def rough_sum(spark, sf_dir):
    h = hits(spark, sf_dir)
    big = h.where("type = 2 and area > 12000").select("run_id", "time", (F.col("time") + DAY // 4).alias("endtime"))
    regions = iv.merge_intervals(big, width=WIDTH).withColumn("region", F.col("time"))
    return pk.rough_sum(h, regions, 1800 * SECOND, width=WIDTH)


@query("high_energy_veto", f"""WITH {HITS_SQL}, {_REGIONS}, ps AS (SELECT run_id, region, region + bin * {1800 * SECOND} - {300 * SECOND} AS a, region + (bin + 1) * {1800 * SECOND} + {300 * SECOND} AS b
FROM (SELECT *, max(area) OVER (PARTITION BY run_id, region) AS top FROM rs) WHERE area > top * 0.5),
al AS (SELECT * FROM ps UNION ALL SELECT run_id, time, endtime, endtime FROM rg),
gp AS (SELECT run_id, coalesce(max(b) OVER (PARTITION BY run_id, region ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), region) AS time, a AS endtime FROM al)
SELECT run_id, time, endtime FROM gp WHERE endtime - time > {600 * SECOND}""")
def high_energy_veto(spark, sf_dir):
    h = hits(spark, sf_dir)
    return pk.high_energy_veto(h.where("type = 2"), h, 12000, DAY // 4, 1800 * SECOND, 0.5, 300 * SECOND, width=WIDTH)


@query("first_seconds", f"WITH {HITS_SQL} SELECT run_id, hit_id FROM hits WHERE time - (k % 4) * 10 * {60 * SECOND} < {RUN_START + 2 * DAY}")
def first_seconds(spark, sf_dir):
    r = hits(spark, sf_dir).withColumns({"record_i": F.col("k") % 4, "length": F.lit(10), "dt": F.lit(60 * SECOND)})
    return pk.first_seconds(r, RUN_START, 2 * 86400).select("run_id", "hit_id")


@query("time_within", f"WITH {HITS_SQL}, {EVENTS_SQL} SELECT run_id, hit_id FROM hits h WHERE EXISTS (SELECT 1 FROM evts e WHERE e.run_id = h.run_id AND h.time >= e.time AND h.endtime <= e.endtime)")
def time_within(spark, sf_dir):
    h, e = _events(spark, sf_dir)
    return se.time_within(h, e, width=WIDTH).select("run_id", "hit_id")


@query("single_electrons", f"WITH {HITS_SQL} SELECT run_id, hit_id FROM hits WHERE type = 2 AND area / 100.0 > 10 AND area / 100.0 < 80 AND k * 10 > 80 AND k * 10 < 700 AND x <> 0")
def single_electrons(spark, sf_dir):
    h = hits(spark, sf_dir).withColumns({"area": F.col("area") / 100.0, "range_50p": F.col("k") * 10, "area_fraction_top": F.col("x")})
    return se.single_electrons(h).select("run_id", "hit_id")


@query("channel_thresholds", f"WITH {HITS_SQL} SELECT run_id, hit_id FROM hits WHERE area >= CASE WHEN channel % 10 < 5 THEN 3000 ELSE 9000 END")
def channel_thresholds(spark, sf_dir):
    """Every channel of the table has a threshold, by its place on its board."""
    h = hits(spark, sf_dir)
    low = F.col("channel") % 10 < 5
    return se.over_threshold(h, h.where("channel is not null").select("channel", F.when(low, 3000).otherwise(9000).alias("threshold")).distinct()).select("run_id", "hit_id")


@query("boolean_partition", f"WITH {HITS_SQL} SELECT run_id, hit_id, coalesce(nullif(k, 7) > 50, false) AS passed FROM hits")
def boolean_partition(spark, sf_dir):
    yes, no = se.partition(hits(spark, sf_dir), F.nullif(F.col("k"), F.lit(7)) > 50)
    return yes.select("run_id", "hit_id", F.lit(True).alias("passed")).unionByName(no.select("run_id", "hit_id", F.lit(False).alias("passed")))


@query("run_tags", "SELECT c_custkey AS run_id FROM customer WHERE (c_mktsegment LIKE 'A%' OR c_mktsegment LIKE '%ING') AND c_mktsegment NOT LIKE '%UILD%' AND c_custkey BETWEEN 20 AND 1000 AND EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def run_tags(spark, sf_dir):
    runs = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("run_id"), F.col("c_custkey").alias("number"), F.array("c_mktsegment").alias("tags"))
    stored = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("run_id"))
    return se.select_runs(runs, stored, ["A*", "*ING"], ["*UILD*"], 20, 1000).select("run_id")


@query("cable_map", f"WITH {HITS_SQL} SELECT run_id, hit_id, CASE WHEN channel < 120 THEN channel // 8 END AS board, CASE WHEN channel < 120 AND channel // 8 < 12 THEN (channel // 8) % 3 END AS link FROM hits")
def cable_map(spark, sf_dir):
    channels = spark.range(120).select(F.col("id").alias("channel"), F.expr("id div 8").alias("board"))
    boards = spark.range(12).select(F.col("id").alias("board"), (F.col("id") % 3).alias("link"))
    return se.cable_map(hits(spark, sf_dir), channels, boards).select("run_id", "hit_id", "board", "link")


@query("daq_plot", f"WITH {HITS_SQL} SELECT run_id, time // {DAY} AS time_bin, (channel // 8) % 3 AS link, CAST(sum(area) AS BIGINT) AS area FROM hits WHERE channel IS NOT NULL GROUP BY 1, 2, 3")
def daq_plot(spark, sf_dir):
    """Every channel of the table is on a board of eight, every board on one of three links."""
    h = hits(spark, sf_dir)
    channels = h.where("channel is not null").select("channel", F.expr("channel div 8").alias("board")).distinct()
    boards = channels.select("board", (F.col("board") % 3).alias("link")).distinct()
    linked = se.cable_map(h, channels, boards).where("link is not null")
    return linked.groupBy("run_id", F.expr(f"time div {DAY}L").alias("time_bin"), "link").agg(F.sum("area").alias("area"))


@query("energy_spectrum", "SELECT CAST(least(39, floor((o_totalprice - 0) / 500000.0 * 40)) AS BIGINT) AS bin, count(*) AS count, round(count(*) / (2.5 * 12500.0), 6) AS rate, round(sqrt(count(*)) / (2.5 * 12500.0), 6) AS error FROM orders WHERE o_totalprice BETWEEN 0 AND 500000 GROUP BY 1")
def energy_spectrum(spark, sf_dir):
    s = se.energy_spectrum(table(spark, sf_dir, "orders"), "o_totalprice", 0, 500000, 40, 2.5)
    return s.select("bin", "count", F.round("rate", 6).alias("rate"), F.round("error", 6).alias("error"))


@query("hit_position_mode", f"WITH {HITS_SQL}, c AS (SELECT run_id, channel, k, count(*) AS n FROM hits GROUP BY 1, 2, 3) SELECT run_id, channel, k AS mode FROM (SELECT *, row_number() OVER (PARTITION BY run_id, channel ORDER BY n DESC, k) AS r FROM c) WHERE r = 1")
def hit_position_mode(spark, sf_dir):
    return se.smallest_mode(hits(spark, sf_dir), "k", ["run_id", "channel"])


@query("median_baseline", f"WITH {WAVES_SQL} SELECT wave_id, list_median(data) AS baseline FROM waves")
def median_baseline(spark, sf_dir):
    return se.median_baseline(waveforms(spark, sf_dir)).select("wave_id", "baseline")


@query("data_sizes", "SELECT o_custkey AS run_id, o_orderpriority AS data_type, CAST(sum(o_orderkey) AS BIGINT) AS n_bytes, count(*) AS n_chunks FROM orders GROUP BY 1, 2")
def data_sizes(spark, sf_dir):
    m = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("run_id"), F.col("o_orderpriority").alias("data_type"), F.col("o_orderkey").alias("n_bytes"))
    return se.data_sizes(m)


@query("split_seconds", f"WITH {HITS_SQL} SELECT run_id, hit_id, center_time // {SECOND} AS seconds, center_time % {SECOND} AS rest FROM hits")
def split_seconds(spark, sf_dir):
    s, r = se.split_seconds(F.col("center_time"))
    return hits(spark, sf_dir).select("run_id", "hit_id", s.alias("seconds"), r.alias("rest"))


@query("local_time", f"WITH {HITS_SQL} SELECT run_id, hit_id, strftime(make_timestamp(time // 1000) + INTERVAL 5 HOURS + INTERVAL 30 MINUTES, '%Y-%m-%d %H:%M:%S') AS wall FROM hits")
def local_time(spark, sf_dir):
    return hits(spark, sf_dir).select("run_id", "hit_id", F.date_format(se.local_time(F.col("time"), "Asia/Kolkata"), "yyyy-MM-dd HH:mm:ss").alias("wall"))


@query("dataset_ids", "SELECT o_orderkey, 'exp_' || lpad(CAST(o_custkey AS VARCHAR), 6, '0') || ':' || lower(o_orderstatus) || '-' || substr(md5(o_orderpriority), 1, 10) AS did, lpad(CAST(o_custkey AS VARCHAR), 6, '0') AS run_id, lower(o_orderstatus) AS data_type, substr(md5(o_orderpriority), 1, 10) AS lineage FROM orders")
def dataset_ids(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    did = se.dataset_id(F.lpad(F.col("o_custkey").cast("string"), 6, "0"), F.lower("o_orderstatus"), F.substring(F.md5("o_orderpriority"), 1, 10))
    named = o.select("o_orderkey", did.alias("did"))
    return named.select("o_orderkey", "did", *[c.alias(n) for n, c in se.parse_dataset_id(F.col("did")).items()])


@query("event_scatter", f"WITH {HITS_SQL} SELECT run_id, hit_id AS event_number, CASE WHEN type = 1 THEN CAST(area AS DOUBLE) ELSE 0 END AS cs1, CASE WHEN type = 2 THEN CAST(area AS DOUBLE) ELSE 0 END AS cs2, least(k / 100.0, 0.9) AS color FROM hits")
def event_scatter(spark, sf_dir):
    h = hits(spark, sf_dir)
    e = h.select("run_id", F.col("hit_id").alias("event_number"), "k", F.when(F.col("type") == 1, F.col("area")).alias("cs1"), F.when(F.col("type") == 2, F.col("area").cast("double")).otherwise(float("nan")).alias("cs2"))
    return se.event_scatter(e, F.col("k") / 100.0)


@query("peak_classification", f"WITH {HITS_SQL} SELECT run_id, type, count(*) AS n, CAST(sum(area) AS BIGINT) AS area, min(k) AS least_width, max(k) AS most_width FROM hits GROUP BY 1, 2")
def peak_classification(spark, sf_dir):
    return hits(spark, sf_dir).groupBy("run_id", "type").agg(F.count(F.lit(1)).alias("n"), F.sum("area").alias("area"), F.min("k").alias("least_width"), F.max("k").alias("most_width"))


@query("event_display", f"WITH {HITS_SQL}, {EVENTS_SQL} SELECT h.run_id, h.hit_id FROM evts e JOIN hits h ON h.run_id = e.run_id AND h.time < e.endtime AND h.endtime > e.time WHERE e.run_id = '000001' AND e.event_number = 2")
def event_display(spark, sf_dir):
    h, e = _events(spark, sf_dir)
    return se.event_display(e, h, "000001", 2).select("run_id", "hit_id")


@query("veto_display", f"WITH {HITS_SQL}, {_MERGED} SELECT run_id, type, hit_id, center_time, x, y, area FROM hits WHERE time >= {RUN_START + DAY} AND endtime <= {RUN_START + 2 * DAY} AND channel BETWEEN 0 AND 9")
def veto_display(spark, sf_dir):
    """The bounded projection behind a veto event display: one time range, one range of channels."""
    h = iv.select_time(hits(spark, sf_dir), RUN_START + DAY, RUN_START + 2 * DAY)
    return h.where(iv.in_channels(F.col("channel"), 0, 9)).select("run_id", "type", "hit_id", "center_time", "x", "y", "area")


@query("histogram_selection", f"WITH {HITS_SQL} SELECT run_id, hit_id, CASE WHEN area >= 0 AND area < 40000 THEN CAST(floor(area / 40000.0 * 20) AS BIGINT) ELSE -1 END AS bin FROM hits WHERE CASE WHEN area >= 0 AND area < 40000 THEN floor(area / 40000.0 * 20) ELSE -1 END IN (2, 3, 7)")
def histogram_selection(spark, sf_dir):
    """Rows of chosen bins of an interactive histogram."""
    h = hits(spark, sf_dir).withColumn("bin", mo.half_open_bin(F.col("area"), 0, 40000, 20))
    return h.where(F.col("bin").isin(2, 3, 7)).select("run_id", "hit_id", "bin")


@query("channels_in_both", f"WITH {HITS_SQL}, c AS (SELECT channel, list_distinct(list(run_id) FILTER (type = 1)) AS a, list_distinct(list(run_id) FILTER (type = 2)) AS b FROM hits GROUP BY 1) SELECT channel, coalesce(len(list_intersect(a, b)), 0) AS n_runs FROM c")
def channels_in_both(spark, sf_dir):
    """Runs in which a channel has signals of both types: an intersection of sets."""
    sets = hits(spark, sf_dir).groupBy("channel").agg(*[F.collect_set(F.when(F.col("type") == t, F.col("run_id"))).alias(n) for t, n in ((1, "a"), (2, "b"))])
    return sets.select("channel", F.size(F.array_intersect("a", "b")).cast("long").alias("n_runs"))


def _disjoint(spark, sf_dir):
    """Peaklets of the hits of type 2, in seconds, as even pulses; every 31st is of type 0."""
    p = pinned(pk.find_peaklets(hits(spark, sf_dir).where("type = 2"), 0, width=WIDTH))
    length = (F.col("endtime") - F.col("time")) / SECOND
    return p.select(
        "run_id", "peaklet", F.expr(f"time div {SECOND}L").alias("time"), F.expr(f"endtime div {SECOND}L").alias("endtime"), (F.col("area") / 100.0).alias("area"),
        F.when(F.col("peaklet") % 31 == 0, 0).otherwise(2).alias("type"), (length / 2).alias("median_time"), F.transform(F.sequence(F.lit(-5), F.lit(5)), lambda k: k / 10.0 * length).alias("area_decile_from_midpoint"),
        F.lit(0.7).alias("area_fraction_top"), (F.col("peaklet") % 40 - 20).cast("double").alias("x"), (F.col("peaklet") % 7).cast("double").alias("y"),
    )


def _assigned(spark, sf_dir):
    peaklets = _disjoint(spark, sf_dir)
    return peaklets, pinned(po.assign_clusters(peaklets, width=WIDTH // SECOND))


def _sampled(spark, sf_dir):
    """The same peaklets, some of them S1s, with eight uneven samples each."""
    p = _disjoint(spark, sf_dir)
    samples = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.col("area") * ((F.col("peaklet") + i * i) % 5 + 1) / 8)
    kind = F.when(F.col("peaklet") % 7 == 3, 1).otherwise(F.col("type"))
    return p.withColumns({"type": kind, "data": samples, "dt": (F.col("endtime") - F.col("time")) / 8})


#: S1s are not left out from the start, and places count as well as splits.
MERGE_RULES = mg.MergeRules(spreads=mg.SPREADS, without_s1=False)


@query("s2_merge_islands")
def s2_merge_islands(spark, sf_dir):
    """Merging gap after gap, by area, duration, spread and goodness of split."""
    p = pinned(_sampled(spark, sf_dir))
    found = mg.assign_merges(p, MERGE_RULES, "data", key="peaklet", width=WIDTH // SECOND).where("merged")
    parts = found.join(p, ["run_id", "peaklet"]).groupBy("run_id", "cluster")
    return parts.agg(F.min("time").alias("time"), F.max("endtime").alias("endtime"), F.round(F.sum("area"), 4).alias("area"), F.count(F.lit(1)).alias("n_merged"))


@query("s2_merge_posterior")
def s2_merge_posterior(spark, sf_dir):
    peaklets, found = _assigned(spark, sf_dir)
    merged = po.merged_peaks(found, peaklets, width=WIDTH // SECOND)
    return merged.select("run_id", "cluster", "time", "endtime", F.round("area", 4).alias("area"), "n_merged", "n_aside", "type")


@query("enhanced_types")
def enhanced_types(spark, sf_dir):
    """Types after merging, and whether a peaklet went into a merged peak."""
    peaklets, found = _assigned(spark, sf_dir)
    return po.enhanced_types(peaklets, found, po.merged_peaks(found, width=WIDTH // SECOND), width=WIDTH // SECOND)


@query("pulse_processing", f"""WITH {WAVES_SQL}, r AS (SELECT wave_id, wave_id // 2 AS pulse, wave_id % 2 AS record_i, 64 - label AS n, data, list_avg(data[1:16]) AS own FROM waves),
b AS (SELECT *, coalesce(max(own) FILTER (record_i = 0) OVER (PARTITION BY pulse), own) AS base FROM r),
s AS (SELECT wave_id, base, i, CASE WHEN i <= n THEN CAST(floor(base) AS BIGINT) - data[i] ELSE 0 END AS v FROM b, range(1, 65) q(i)),
h AS (SELECT *, v >= 150 AS o, coalesce(lag(v) OVER (PARTITION BY wave_id ORDER BY i), 0) < 150 AS up, max(CASE WHEN v >= 150 THEN 1 ELSE 0 END) OVER (PARTITION BY wave_id ORDER BY i ROWS BETWEEN 20 PRECEDING AND 3 FOLLOWING) AS k FROM s)
SELECT wave_id, round(max(base), 6) AS baseline, CAST(sum(v) AS BIGINT) AS area, CAST(sum(v * k) AS BIGINT) AS kept_area, count(*) FILTER (o AND up) AS n_hits FROM h GROUP BY 1""")
def pulse_processing(spark, sf_dir):
    """Waveforms as raw fragments, two to a pulse, some of them shorter than their array."""
    raw = waveforms(spark, sf_dir).select("wave_id", F.expr("wave_id div 2").alias("pulse"), (F.col("wave_id") % 2).alias("record_i"), (64 - F.col("label")).alias("length"), "data")
    found = rc.process_records(raw, ["wave_id"], 150, 16, pulse=["pulse"])
    kept = F.aggregate("data", F.lit(0.0), lambda a, x: a + x).cast("long")
    return found.select("wave_id", F.round("baseline", 6).alias("baseline"), F.col("area").cast("long").alias("area"), kept.alias("kept_area"), F.col("n_hits").cast("long").alias("n_hits"))
