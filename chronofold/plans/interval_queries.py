"""Queries over the interval algebra, event building and neighbourhood scores, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofold.operators import events as ev
from chronofold.operators import intervals as iv
from chronofold.operators import neighbourhood as nb
from chronofold.operators import ordered
from chronofold.plans.registry import query
from chronofold.sources.adapter import DAY, HITS_SQL, RUN_END, RUN_START, SECOND, gains, hits, triggers
from chronofold.session import table

LEFT, RIGHT, MIN_AREA = 1200 * SECOND, 600 * SECOND, 12000
WIDTH = DAY
AREA_SUM = "CAST({} AS BIGINT)"

EVENTS_SQL = f"""
trig AS (SELECT run_id, time FROM hits WHERE type = 2 AND area > {MIN_AREA}),
isl AS (SELECT run_id, time, sum(new) OVER (PARTITION BY run_id ORDER BY time) AS island FROM (
  SELECT run_id, time, CASE WHEN time - lag(time) OVER (PARTITION BY run_id ORDER BY time) <= {LEFT + RIGHT} THEN 0 ELSE 1 END AS new FROM trig)),
spans AS (SELECT run_id, island, greatest(min(time) - {LEFT}, {RUN_START}) AS time, least(max(time) + {RIGHT}, {RUN_END}) AS endtime FROM isl GROUP BY run_id, island),
evts AS (SELECT run_id, time, endtime, row_number() OVER (PARTITION BY run_id ORDER BY time) - 1 AS event_number FROM spans s
  WHERE NOT EXISTS (SELECT 1 FROM hits h WHERE h.run_id = s.run_id AND h.type = 3 AND h.time >= s.time AND h.endtime <= s.endtime))"""


def _events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    h = hits(spark, sf_dir)
    return h, ev.build_events(h, triggers(h, MIN_AREA), LEFT, RIGHT, RUN_START, RUN_END, width=WIDTH)


@query("event_building", f"WITH {HITS_SQL}, {EVENTS_SQL} SELECT run_id, event_number, time, endtime FROM evts")
def event_building(spark, sf_dir):
    return _events(spark, sf_dir)[1].select("run_id", "event_number", "time", "endtime")


DRIFT = 1500 * SECOND
_BASICS = f"""WITH {HITS_SQL}, {EVENTS_SQL},
inside AS (SELECT h.*, e.event_number FROM hits h JOIN evts e ON h.run_id = e.run_id AND h.time >= e.time AND h.endtime <= e.endtime),
m2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run_id, event_number ORDER BY area DESC, time DESC, hit_id DESC) AS r FROM inside WHERE type = 2) WHERE r = 1),
r1 AS (SELECT i.*, row_number() OVER (PARTITION BY run_id, event_number ORDER BY i.area DESC, i.time DESC, i.hit_id DESC) AS r
       FROM inside i LEFT JOIN m2 USING (run_id, event_number) WHERE i.type = 1 AND i.k >= 2 AND (m2.time IS NULL OR i.time < m2.time)),
m1 AS (SELECT * FROM r1 WHERE r = 1), a1 AS (SELECT * FROM r1 WHERE r = 2),
a2 AS (SELECT * FROM (SELECT i.*, row_number() OVER (PARTITION BY run_id, event_number ORDER BY i.area DESC, i.time DESC, i.hit_id DESC) AS r
       FROM inside i JOIN m2 USING (run_id, event_number) LEFT JOIN m1 USING (run_id, event_number)
       WHERE i.type = 2 AND i.hit_id <> m2.hit_id AND (m1.time IS NULL OR (i.center_time > m1.center_time AND i.center_time - m1.center_time < 1.01 * {DRIFT}))) WHERE r = 1),
s AS (SELECT run_id, event_number, sum(CASE WHEN i.center_time < m2.center_time THEN i.area END) AS before_sum,
        max(CASE WHEN i.center_time < m2.center_time THEN i.area END) AS before_max, max(CASE WHEN i.center_time > m2.center_time THEN i.area END) AS after_max
      FROM inside i JOIN m2 USING (run_id, event_number) WHERE i.type = 2 GROUP BY run_id, event_number),
n AS (SELECT run_id, event_number, count(*) AS n FROM inside GROUP BY run_id, event_number)
SELECT run_id, event_number, e.time, e.endtime, CAST(coalesce(n.n, 0) AS BIGINT) AS n_peaks, m1.hit_id AS s1_id, a1.hit_id AS alt_s1_id, m2.hit_id AS s2_id, a2.hit_id AS alt_s2_id,
       m1.area AS s1_area, m2.area AS s2_area, CASE WHEN m1.hit_id IS NOT NULL AND m2.hit_id IS NOT NULL THEN m2.center_time - m1.center_time END AS drift_time,
       CAST(coalesce(s.before_sum, 0) AS BIGINT) AS area_before_main_s2, s.before_max AS large_before, s.after_max AS large_after
FROM evts e LEFT JOIN n USING (run_id, event_number) LEFT JOIN m1 USING (run_id, event_number) LEFT JOIN a1 USING (run_id, event_number) LEFT JOIN m2 USING (run_id, event_number)
LEFT JOIN a2 USING (run_id, event_number) LEFT JOIN s USING (run_id, event_number)"""


def _basics(spark, sf_dir):
    h, e = _events(spark, sf_dir)
    return ev.event_basics(h.withColumn("tight_coincidence", F.col("k")), e, DRIFT, width=WIDTH)


@query("event_basics", _BASICS)
def event_basics(spark, sf_dir):
    b = _basics(spark, sf_dir)
    names = {"s1_hit_id": "s1_id", "alt_s1_hit_id": "alt_s1_id", "s2_hit_id": "s2_id", "alt_s2_hit_id": "alt_s2_id"}
    return b.select(
        "run_id", "event_number", "time", "endtime", "n_peaks", *[F.col(c).alias(n) for c, n in names.items()], "s1_area", "s2_area", "drift_time", "area_before_main_s2",
        F.col("large_s2_before_main_s2_area").alias("large_before"), F.col("large_s2_after_main_s2_area").alias("large_after"),
    )


@query("event_info_double", _BASICS.replace("m1.hit_id AS s1_id", "m1.hit_id AS s1_a_hit_id").replace("a1.hit_id AS alt_s1_id", "a1.hit_id AS s1_b_hit_id")
       .replace("m2.hit_id AS s2_id", "m2.hit_id AS s2_a_hit_id").replace("a2.hit_id AS alt_s2_id", "a2.hit_id AS s2_b_hit_id").replace("m1.area AS s1_area", "m1.area AS s1_a_area")
       .replace("m2.area AS s2_area", "m2.area AS s2_a_area").replace(", s.before_max AS large_before, s.after_max AS large_after", ""))
def event_info_double(spark, sf_dir):
    d = ev.as_double_scatter(_basics(spark, sf_dir))
    return d.select("run_id", "event_number", "time", "endtime", "n_peaks", "s1_a_hit_id", "s1_b_hit_id", "s2_a_hit_id", "s2_b_hit_id", "s1_a_area", "s2_a_area", "drift_time", "area_before_main_s2")


@query("peak_event_number", f"""WITH b AS ({_BASICS}), {HITS_SQL}
SELECT h.run_id, h.hit_id, coalesce(b.event_number, -1) AS event_number, CASE WHEN h.type = 2 THEN h.center_time - m.center_time END AS drift_time
FROM hits h LEFT JOIN b ON h.run_id = b.run_id AND h.time >= b.time AND h.endtime <= b.endtime LEFT JOIN hits m ON m.run_id = b.run_id AND m.hit_id = b.s1_id""")
def peak_event_number(spark, sf_dir):
    return ev.event_number_of(hits(spark, sf_dir), _basics(spark, sf_dir), width=WIDTH)


N_FOLD, RESOLVING = 4, 900 * SECOND


def _coincidence_sql(n: int) -> str:
    return f"""opens AS (SELECT run_id, time FROM (SELECT run_id, time, lead(time, {n - 1}) OVER (PARTITION BY run_id ORDER BY time, hit_id) AS nth FROM hits) WHERE nth - time < {RESOLVING}),
spans0 AS (SELECT run_id, time - {SECOND} AS time, time + {RESOLVING} AS endtime FROM opens),
marked AS (SELECT *, sum(new) OVER (PARTITION BY run_id ORDER BY time) AS g FROM (SELECT *, CASE WHEN time <= lag(endtime) OVER (PARTITION BY run_id ORDER BY time) THEN 0 ELSE 1 END AS new FROM spans0)),
coin AS (SELECT run_id, min(time) AS time, max(endtime) AS endtime FROM marked GROUP BY run_id, g)"""


@query("coincidence_nfold", f"WITH {HITS_SQL}, {_coincidence_sql(N_FOLD)} SELECT * FROM coin")
def coincidence_nfold(spark, sf_dir):
    return iv.coincidence(hits(spark, sf_dir), N_FOLD, RESOLVING, SECOND, width=WIDTH)


@query("coincidence_single", f"WITH {HITS_SQL}, {_coincidence_sql(1)} SELECT * FROM coin")
def coincidence_single(spark, sf_dir):
    return iv.coincidence(hits(spark, sf_dir), 1, RESOLVING, SECOND, width=WIDTH)


_MERGED = """mk AS (SELECT run_id, time, endtime, CASE WHEN time <= max(endtime) OVER (PARTITION BY run_id ORDER BY time, endtime ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM hits),
merged AS (SELECT run_id, min(time) AS time, max(endtime) AS endtime FROM (SELECT *, sum(new) OVER (PARTITION BY run_id ORDER BY time, endtime) AS g FROM mk) GROUP BY run_id, g)"""


@query("merge_intervals", f"WITH {HITS_SQL}, {_MERGED} SELECT run_id, time, endtime FROM merged")
def merge_intervals(spark, sf_dir):
    return iv.merge_intervals(hits(spark, sf_dir), width=WIDTH)


@query("outside_intervals", f"""WITH {HITS_SQL}, {_MERGED}, g AS (SELECT run_id, lag(endtime) OVER (PARTITION BY run_id ORDER BY time) AS a, time AS b FROM merged UNION ALL SELECT run_id, max(endtime), {RUN_END} FROM merged GROUP BY 1)
SELECT run_id, coalesce(a, {RUN_START}) AS time, b AS endtime FROM g WHERE coalesce(a, {RUN_START}) < b""")
def outside_intervals(spark, sf_dir):
    return iv.complement(iv.merge_intervals(hits(spark, sf_dir), width=WIDTH), RUN_START, RUN_END, width=WIDTH)


@query("split_by_containment", f"WITH {HITS_SQL}, {_coincidence_sql(N_FOLD)} SELECT h.run_id, hit_id, c.time AS container FROM hits h JOIN coin c ON h.run_id = c.run_id AND h.time >= c.time AND h.endtime <= c.endtime")
def split_by_containment(spark, sf_dir):
    h = hits(spark, sf_dir)
    c = iv.coincidence(h, N_FOLD, RESOLVING, SECOND, width=WIDTH).withColumn("container", F.col("time"))
    return iv.split_by_containment(h, c, "container", width=WIDTH).select("run_id", "hit_id", "container")


@query("lone_hits", f"WITH {HITS_SQL}, {_coincidence_sql(N_FOLD)} SELECT run_id, hit_id FROM hits h WHERE NOT EXISTS (SELECT 1 FROM coin c WHERE h.run_id = c.run_id AND h.time >= c.time AND h.endtime <= c.endtime)")
def lone_hits(spark, sf_dir):
    h = hits(spark, sf_dir)
    return iv.outside(h, iv.coincidence(h, N_FOLD, RESOLVING, SECOND, width=WIDTH), "hit_id", width=WIDTH, disjoint=True).select("run_id", "hit_id")


ROI = 600 * SECOND


@query("touching_windows", f"WITH {HITS_SQL} SELECT p.run_id, p.hit_id, count(*) AS n_touching, CAST(sum(o.area) AS BIGINT) AS area_touching FROM hits p JOIN hits o ON o.run_id = p.run_id AND o.time < p.time AND o.endtime > p.time - {ROI} WHERE p.type = 2 GROUP BY 1, 2")
def touching_windows(spark, sf_dir):
    h = hits(spark, sf_dir)
    roi = h.where("type = 2").select("run_id", (F.col("time") - ROI).alias("time"), F.col("time").alias("endtime"), "hit_id")
    met = iv.overlap_join(h.select("run_id", "time", "endtime", "area"), roi, width=ROI)
    return met.groupBy("run_id", F.col("w_hit_id").alias("hit_id")).agg(F.count(F.lit(1)).alias("n_touching"), F.sum("area").alias("area_touching"))


NEAR = 3600 * SECOND


@query("nearest_trigger", f"""WITH {HITS_SQL}, t AS (SELECT run_id AS tr, hit_id AS tid, time AS tt, area AS ta FROM hits WHERE type = 2),
n AS (SELECT h.run_id, h.hit_id, l.tid AS li, l.ta AS la, h.time - l.tt AS ld, r.tid AS ri, r.ta AS ra, r.tt - h.time AS rd FROM hits h
ASOF LEFT JOIN t l ON h.run_id = l.tr AND h.time > l.tt ASOF LEFT JOIN t r ON h.run_id = r.tr AND h.time < r.tt)
SELECT run_id, hit_id, CASE WHEN ld <= {NEAR} THEN li END AS left_id, CASE WHEN ld <= {NEAR} THEN la END AS left_area, CASE WHEN ld <= {NEAR} THEN ld END AS left_dt,
CASE WHEN rd <= {NEAR} THEN ri END AS right_id, CASE WHEN rd <= {NEAR} THEN ra END AS right_area, CASE WHEN rd <= {NEAR} THEN rd END AS right_dt FROM n""")
def nearest_trigger(spark, sf_dir):
    h = hits(spark, sf_dir)
    near = iv.nearest_triggers(h.select("run_id", "time", "hit_id"), h.where("type = 2"), ["hit_id", "area"], NEAR, width=WIDTH)
    return near.select("run_id", "hit_id", F.col("left_hit_id").alias("left_id"), "left_area", "left_dt", F.col("right_hit_id").alias("right_id"), "right_area", "right_dt")


@query("nearest_abs", f"""WITH {HITS_SQL}, t AS (SELECT run_id AS tr, hit_id AS tid, time AS tt FROM hits WHERE type = 3), q AS (SELECT * FROM hits WHERE type = 1)
SELECT h.run_id, h.hit_id, CASE WHEN r.tt IS NULL OR (l.tt IS NOT NULL AND h.time - l.tt <= r.tt - h.time) THEN l.tid ELSE r.tid END AS nearest_id
FROM q h ASOF LEFT JOIN t l ON h.run_id = l.tr AND h.time >= l.tt ASOF LEFT JOIN t r ON h.run_id = r.tr AND h.time <= r.tt""")
def nearest_abs(spark, sf_dir):
    h = hits(spark, sf_dir)
    near = iv.nearest_absolute(h.where("type = 1").select("run_id", "time", "hit_id"), h.where("type = 3"), ["hit_id"], width=WIDTH)
    return near.select("run_id", "hit_id", F.col("n_hit_id").alias("nearest_id"))


_VETO = f"""sig AS (SELECT run_id, time, (row_number() OVER (PARTITION BY run_id ORDER BY time) + CAST(run_id AS BIGINT)) % 2 AS kind FROM hits WHERE type = 3),
ends AS (SELECT run_id, max(time) FILTER (kind = 1) AS a, max(time) FILTER (kind = 0) AS b, min(time) FILTER (kind = 1) AS c, min(time) FILTER (kind = 0) AS d FROM sig GROUP BY 1),
allsig AS (SELECT * FROM sig UNION ALL SELECT run_id, {RUN_END}, 0 FROM ends WHERE a > b UNION ALL SELECT run_id, {RUN_START}, 1 FROM ends WHERE d < c),
veto AS (SELECT run_id, time, nt AS endtime FROM (SELECT *, lead(time) OVER (PARTITION BY run_id ORDER BY time) AS nt FROM allsig) WHERE kind = 1)"""


def _veto(h: DataFrame) -> DataFrame:
    signals = ordered.row_numbers(h.where("type = 3").select("run_id", "time"), "n", iv.RUN, ("time",), WIDTH)
    kind = (F.col("n") + 1 + F.col("run_id").cast("long")) % 2
    return iv.pair_starts_stops(signals.where(kind == 1), signals.where(kind == 0), RUN_START, RUN_END, width=WIDTH, name="he_")


@query("veto_intervals", f"""WITH {HITS_SQL}, {_VETO} SELECT run_id, time, endtime, 'he_veto' AS veto_type, endtime - time AS veto_interval FROM veto
UNION ALL SELECT run_id, time, endtime, 'artificial_deadtime_veto', endtime - time FROM hits WHERE k > 97""")
def veto_intervals(spark, sf_dir):
    h = hits(spark, sf_dir)
    dead = iv.pair_starts_stops(h.limit(0), h.limit(0), RUN_START, RUN_END, width=WIDTH, artificial=h.where("k > 97"))
    return _veto(h).unionByName(dead)


@query("veto_overlap", f"""WITH {HITS_SQL}, {EVENTS_SQL}, {_VETO} SELECT e.run_id, e.event_number, CAST(coalesce(sum(CASE WHEN v.time IS NOT NULL THEN least(e.endtime, v.endtime) - greatest(e.time, v.time) END), 0) AS BIGINT) AS overlap
FROM evts e LEFT JOIN veto v ON v.run_id = e.run_id AND v.time < e.endtime AND e.time < v.endtime GROUP BY 1, 2""")
def veto_overlap(spark, sf_dir):
    h, e = _events(spark, sf_dir)
    return iv.overlap_duration(e, _veto(h), "event_number", width=WIDTH)


@query("prev_next_interval", f"""WITH {HITS_SQL}, {EVENTS_SQL}, {_VETO}, s AS (SELECT run_id AS sr, time AS st FROM veto), f AS (SELECT run_id AS fr, endtime AS en FROM veto)
SELECT e.run_id, e.event_number, e.time - f.en AS to_previous, s.st - e.endtime AS to_next FROM evts e ASOF LEFT JOIN f ON e.run_id = f.fr AND e.time > f.en ASOF LEFT JOIN s ON e.run_id = s.sr AND e.endtime < s.st""")
def prev_next_interval(spark, sf_dir):
    h, e = _events(spark, sf_dir)
    return iv.distance_to_neighbours(e, _veto(h), "event_number", width=WIDTH)


@query("isolated_hits", f"""WITH {HITS_SQL}, n AS (SELECT run_id, hit_id, time - lag(time) OVER w AS l, lead(time) OVER w - time AS r FROM hits WINDOW w AS (PARTITION BY run_id ORDER BY time, hit_id))
SELECT run_id, hit_id FROM n WHERE coalesce(l > {300 * SECOND}, true) AND coalesce(r > {300 * SECOND}, true)""")
def isolated_hits(spark, sf_dir):
    return iv.isolated(hits(spark, sf_dir), 300 * SECOND, width=WIDTH).select("run_id", "hit_id")


@query("check_overlaps", f"WITH {HITS_SQL} SELECT run_id, hit_id FROM (SELECT run_id, hit_id, time, lag(endtime) OVER (PARTITION BY run_id, channel ORDER BY time, endtime) AS p FROM hits) WHERE time < p")
def check_overlaps(spark, sf_dir):
    return iv.check_overlaps(hits(spark, sf_dir), width=WIDTH).select("run_id", "hit_id")


A, B = RUN_START + 5 * DAY, RUN_START + 6 * DAY


@query("time_selection_contained", f"WITH {HITS_SQL} SELECT run_id, hit_id FROM hits WHERE time >= {A} AND endtime <= {B}")
def time_selection_contained(spark, sf_dir):
    return iv.select_time(hits(spark, sf_dir), A, B).select("run_id", "hit_id")


@query("time_selection_touching", f"WITH {HITS_SQL} SELECT run_id, hit_id FROM hits WHERE endtime > {A} AND time < {B}")
def time_selection_touching(spark, sf_dir):
    return iv.select_time(hits(spark, sf_dir), A, B, "touching").select("run_id", "hit_id")


@query("channel_router", f"WITH {HITS_SQL} SELECT run_id, hit_id, CASE WHEN channel <= 39 THEN 'tpc' WHEN channel <= 99 THEN 'veto' ELSE 'monitor' END AS detector FROM hits WHERE NOT channel BETWEEN 100 AND 119")
def channel_router(spark, sf_dir):
    ranges = {"tpc": (0, 39), "veto": (40, 99), "gap_blank": (100, 119), "monitor": (120, 10**9)}
    return iv.route_channels(hits(spark, sf_dir), ranges).select("run_id", "hit_id", "detector")


W = 600 * SECOND


@query("n_competing", f"""WITH {HITS_SQL} SELECT p.run_id, p.hit_id, count(*) FILTER (o.hit_id IS NOT NULL AND o.center_time < p.center_time) AS n_competing_left, count(o.hit_id) AS n_competing
FROM hits p LEFT JOIN hits o ON o.run_id = p.run_id AND o.type IN (1, 2) AND o.time < p.center_time + {W} AND o.endtime > p.center_time - {W} AND o.area > p.area * 0.2 GROUP BY 1, 2""")
def n_competing(spark, sf_dir):
    return nb.competing(hits(spark, sf_dir), W)


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n), 6) for n in names})


@query("proximity_score", f"""WITH {HITS_SQL}, q AS (
SELECT p.run_id, p.hit_id, o.area / CAST(p.area AS DOUBLE) AS r, (p.center_time - o.center_time) / 1e6 AS dt, sqrt((p.x - o.x) ** 2 + (p.y - o.y) ** 2) AS dr,
       22.0 * sqrt(1.0 / o.area + 1.0 / p.area) AS sg
FROM hits p JOIN hits o ON o.run_id = p.run_id AND o.type IN (1, 2) AND o.time < p.center_time AND o.endtime > p.center_time - {W} AND o.center_time < p.center_time AND o.area > 0 AND p.area > 0 AND o.area >= p.area * 0.2
WHERE sqrt((p.x - o.x) ** 2 + (p.y - o.y) ** 2) > 0),
same AS (SELECT DISTINCT p.run_id, p.hit_id FROM hits p JOIN hits o ON o.run_id = p.run_id AND o.type IN (1, 2) AND o.time < p.center_time AND o.endtime > p.center_time - {W} AND o.center_time < p.center_time AND o.area > 0 AND p.area > 0 AND o.area >= p.area * 0.2 WHERE p.x = o.x AND p.y = o.y),
s AS (SELECT run_id, hit_id, sum(r / dt * (2.0 / (pi() * sg * (1 + (dr / sg) ** 2)))) AS v FROM q GROUP BY 1, 2)
SELECT h.run_id, h.hit_id, CASE WHEN same.hit_id IS NOT NULL THEN -1.0 ELSE round(coalesce(s.v, 0) * 1e6, 3) END AS score_micro FROM hits h LEFT JOIN s USING (run_id, hit_id) LEFT JOIN same USING (run_id, hit_id)""")
def proximity_score(spark, sf_dir):
    p = nb.proximity(hits(spark, sf_dir), W)
    infinite = F.col("proximity_score") == float("inf")
    return p.select("run_id", "hit_id", F.when(infinite, -1.0).otherwise(F.round(F.col("proximity_score") * 1e6, 3)).alias("score_micro"))


@query("time_shadow", f"""WITH {HITS_SQL}, q AS (SELECT p.run_id, p.hit_id, p.center_time - o.center_time AS dt, o.area, o.center_time AS c, o.x, o.y FROM hits p JOIN hits o
ON o.run_id = p.run_id AND o.type = 2 AND o.area > 10000 AND o.time < p.center_time AND o.endtime > p.center_time - {W} AND o.center_time < p.center_time),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run_id, hit_id ORDER BY area / CAST(dt AS DOUBLE) DESC, c) AS r FROM q) WHERE r = 1),
n AS (SELECT run_id, hit_id, min(dt) AS nearest_dt FROM q GROUP BY 1, 2)
SELECT h.run_id, h.hit_id, round(coalesce(b.area / CAST(b.dt AS DOUBLE), 10000 / CAST({W} AS DOUBLE)) * 1e9, 3) AS shadow, CAST(coalesce(b.dt, {W}) AS DOUBLE) AS dt, CAST(b.x AS DOUBLE) AS x, n.nearest_dt
FROM hits h LEFT JOIN b USING (run_id, hit_id) LEFT JOIN n USING (run_id, hit_id)""")
def time_shadow(spark, sf_dir):
    s = nb.shadow(hits(spark, sf_dir), W, 10000, 2)
    return s.select("run_id", "hit_id", F.round(F.col("shadow") * 1e9, 3).alias("shadow"), "dt", "x", "nearest_dt")


@query("time_shadow_sum", f"""WITH {HITS_SQL}, q AS (SELECT p.run_id, p.hit_id, sum(o.area / CAST(p.center_time - o.center_time AS DOUBLE)) AS s FROM hits p JOIN hits o
ON o.run_id = p.run_id AND o.type = 2 AND o.area > 10000 AND o.time < p.center_time AND o.endtime > p.center_time - {W} AND o.center_time < p.center_time GROUP BY 1, 2)
SELECT h.run_id, h.hit_id, round(coalesce(q.s, 10000 / CAST({W} AS DOUBLE)) * 1e9, 3) AS shadow FROM hits h LEFT JOIN q USING (run_id, hit_id)""")
def time_shadow_sum(spark, sf_dir):
    s = nb.shadow(hits(spark, sf_dir), W, 10000, 2, as_sum=True)
    return s.select("run_id", "hit_id", F.round(F.col("shadow") * 1e9, 3).alias("shadow"))


@query("position_shadow", f"""WITH {HITS_SQL}, q AS (SELECT p.run_id, p.hit_id, o.area / CAST(p.center_time - o.center_time AS DOUBLE) * (2.0 / (pi() * (15.0 / sqrt(CAST(p.area AS DOUBLE))) *
 (1 + (sqrt((p.x - o.x) ** 2 + (p.y - o.y) ** 2) / (15.0 / sqrt(CAST(p.area AS DOUBLE)))) ** 2))) AS s FROM hits p JOIN hits o
ON o.run_id = p.run_id AND o.type = 2 AND o.area > 10000 AND o.time < p.center_time AND o.endtime > p.center_time - {W} AND o.center_time < p.center_time WHERE p.area > 0)
SELECT h.run_id, h.hit_id, round(coalesce(m.s, 10000 / CAST({W} AS DOUBLE)) * 1e9, 3) AS shadow FROM hits h LEFT JOIN (SELECT run_id, hit_id, max(s) AS s FROM q GROUP BY 1, 2) m USING (run_id, hit_id) WHERE h.area > 0""")
def position_shadow(spark, sf_dir):
    h = hits(spark, sf_dir)
    s = nb.shadow(h.where("area > 0"), W, 10000, 2, position=True)
    return s.select("run_id", "hit_id", F.round(F.col("shadow") * 1e9, 3).alias("shadow"))


@query("ambience", f"""WITH {HITS_SQL},
lh AS (SELECT p.run_id, p.hit_id, count(*) AS n, sum(o.area / CAST(p.center_time - o.time AS DOUBLE)) AS s FROM hits p JOIN hits o ON o.run_id = p.run_id AND o.type = 0 AND o.area > 0 AND o.time < p.center_time AND o.endtime > p.center_time - {W} GROUP BY 1, 2),
s2 AS (SELECT p.run_id, p.hit_id, count(*) AS n, sum(o.area / CAST(p.center_time - o.center_time AS DOUBLE)) AS s, count(*) FILTER (sqrt((p.x - o.x) ** 2 + (p.y - o.y) ** 2) <= 6.7) AS near
  FROM hits p JOIN hits o ON o.run_id = p.run_id AND o.type = 2 AND o.area < 8000 AND o.time < p.center_time AND o.endtime > p.center_time - {W} AND o.center_time < p.center_time GROUP BY 1, 2)
SELECT h.run_id, h.hit_id, coalesce(lh.n, 0) AS n_lh_before, round(coalesce(lh.s, 0) * 1e9 + 1e-5, 2) AS s_lh_before, coalesce(s2.n, 0) AS n_s2_before, round(coalesce(s2.s, 0) * 1e9 + 1e-5, 2) AS s_s2_before, coalesce(s2.near, 0) AS n_s2_near
FROM hits h LEFT JOIN lh USING (run_id, hit_id) LEFT JOIN s2 USING (run_id, hit_id)""")
def ambience(spark, sf_dir):
    h = hits(spark, sf_dir)
    a = nb.ambience(h, h.where("type = 0"), W, {0: 5000, 1: 5000, 2: 8000}, 6.7)
    return a.select("run_id", "hit_id", "n_lh_before", F.round(F.col("s_lh_before") * 1e9 + 1e-5, 2).alias("s_lh_before"), "n_s2_before", F.round(F.col("s_s2_before") * 1e9 + 1e-5, 2).alias("s_s2_before"), "n_s2_near")


@query("se_score", f"""WITH {HITS_SQL}, q AS (SELECT p.run_id, p.hit_id, (1 / sqrt(CAST(o.area AS DOUBLE)) + 0.1) ** 2 + (1 / sqrt(CAST(p.area AS DOUBLE)) + 0.1) ** 2 AS v, (p.x - o.x) ** 2 + (p.y - o.y) ** 2 AS d
FROM hits p JOIN hits o ON o.run_id = p.run_id AND o.type = 1 AND o.area BETWEEN 1000 AND 8000 AND o.time < p.center_time AND o.endtime > p.center_time - {W} WHERE p.area > 0)
SELECT h.run_id, h.hit_id, round(coalesce(s.v, 0), 6) AS se_score FROM hits h LEFT JOIN (SELECT run_id, hit_id, sum(exp(-d / (2 * v)) / (2 * pi() * v)) AS v FROM q GROUP BY 1, 2) s USING (run_id, hit_id) WHERE h.area > 0""")
def se_score(spark, sf_dir):
    h = hits(spark, sf_dir).where("area > 0")
    return _rounded(nb.se_score(h, h.where("type = 1 and area between 1000 and 8000"), W), "se_score")


@query("tight_coincidence", f"""WITH {HITS_SQL} SELECT p.run_id, p.hit_id AS peak_id, count(DISTINCT o.channel) AS tight_coincidence FROM hits p LEFT JOIN hits o ON o.run_id = p.run_id AND o.time BETWEEN p.time - {W} AND p.time + {ROI // 2} WHERE p.type = 2 GROUP BY 1, 2""")
def tight_coincidence(spark, sf_dir):
    h = hits(spark, sf_dir)
    return nb.tight_coincidence(h.where("type = 2").withColumnRenamed("hit_id", "peak_id"), h, W, ROI // 2)


@query("n_hits", f"""WITH {HITS_SQL} SELECT p.run_id, p.hit_id AS peak_id, count(o.hit_id) AS n_hits FROM hits p LEFT JOIN hits o ON o.run_id = p.run_id AND o.time < p.endtime AND p.time < o.endtime WHERE p.type = 2 GROUP BY 1, 2""")
def n_hits(spark, sf_dir):
    h = hits(spark, sf_dir)
    return nb.hits_per_peak(h.where("type = 2").withColumnRenamed("hit_id", "peak_id"), h)


@query("count_before", f"WITH {HITS_SQL} SELECT run_id, hit_id, count(*) OVER (PARTITION BY run_id ORDER BY time RANGE BETWEEN {W} PRECEDING AND 1 PRECEDING) AS n_before FROM hits")
def count_before(spark, sf_dir):
    return nb.count_in_range(hits(spark, sf_dir), W)


@query("multi_scatter", """SELECT l_orderkey, count(*) FILTER (l_quantity > 20) AS multiplicity, round(sum(l_quantity) FILTER (l_quantity > 20), 6) AS l_quantity_sum,
round(sum(l_quantity * l_extendedprice) FILTER (l_quantity > 20) / sum(l_quantity) FILTER (l_quantity > 20) + 1e-6, 2) AS l_extendedprice_avg FROM lineitem GROUP BY 1""")
def multi_scatter(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice")
    m = ev.multi_scatter(rows, "l_orderkey", "l_quantity", ["l_extendedprice"], F.col("l_quantity") > 20, by=())
    return m.withColumns({"l_quantity_sum": F.round("l_quantity_sum", 6), "l_extendedprice_avg": F.round(F.col("l_extendedprice_avg") + 1e-6, 2)})


@query("distinct_channels", """SELECT l_orderkey, count(*) FILTER (a AND NOT b) AS n_distinct_channels FROM (SELECT l_orderkey, l_partkey % 50 AS ch, bool_or(l_returnflag = 'A') AS a, bool_or(l_returnflag = 'N') AS b FROM lineitem GROUP BY 1, 2) GROUP BY 1""")
def distinct_channels(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_partkey") % 50).alias("ch"), "l_returnflag")
    return ev.distinct_channels(rows, "l_orderkey", "ch", F.col("l_returnflag") == "A", F.col("l_returnflag") == "N", by=())


@query("top_largest", f"WITH {HITS_SQL} SELECT hit_id, time, area FROM hits ORDER BY area DESC, time, hit_id LIMIT 25")
def top_largest(spark, sf_dir):
    return ev.largest(hits(spark, sf_dir), 25).select("hit_id", "time", "area")


@query("zero_gain_filter", f"WITH {HITS_SQL} SELECT hit_id, area * (1 + channel % 3) AS pe FROM hits WHERE channel % 17 <> 0")
def zero_gain_filter(spark, sf_dir):
    h = hits(spark, sf_dir)
    live = gains(h).where("gain <> 0")
    return h.join(live, "channel").select("hit_id", (F.col("area") * F.col("gain")).alias("pe"))


@query("trigger_split", f"""WITH {HITS_SQL}, d AS (SELECT run_id, hit_id, time, time - lag(time) OVER (PARTITION BY run_id ORDER BY time, hit_id) AS gap FROM hits WHERE type = 2)
SELECT run_id, hit_id, CAST(sum(CASE WHEN gap <= {W} THEN 0 ELSE 1 END) OVER w AS BIGINT) AS after_more, CAST(sum(CASE WHEN gap < {W} THEN 0 ELSE 1 END) OVER w AS BIGINT) AS after_as_much
FROM d WINDOW w AS (PARTITION BY run_id ORDER BY time, hit_id)""")
def trigger_split(spark, sf_dir):
    """Groups split by gaps of more than W (hitlets), and by gaps of W or more (raw records)."""
    t = hits(spark, sf_dir).where("type = 2").select("run_id", "time", "hit_id")
    more = iv.numbered_islands(t, "time", W, iv.RUN, ("time", "hit_id"), WIDTH).withColumnRenamed("island", "after_more")
    return iv.numbered_islands(more, "time", W, iv.RUN, ("time", "hit_id"), WIDTH, inclusive=False).select("run_id", "hit_id", "after_more", F.col("island").alias("after_as_much"))


@query("running_event_counter", f"WITH {HITS_SQL} SELECT run_id, hit_id, row_number() OVER (PARTITION BY run_id ORDER BY time, hit_id) - 1 AS n FROM hits")
def running_event_counter(spark, sf_dir):
    return ordered.row_numbers(hits(spark, sf_dir), "n", iv.RUN, ("time", "hit_id"), WIDTH).select("run_id", "hit_id", "n")
