"""Scores of a peak from the peaks in a time window around it.

Each operator turns the peaks into regions of interest around their centres. Spark deals both sides to time buckets as wide as the
window, wider ones for longer peaks; there numpy judges the pairs, a block at a time, so none is a row. Competing peaks are counted
without pairs, the others cost their number of neighbours. Ids are unique in a run only.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from chronofold.operators import ordered
from chronofold.operators.executor import floats, map_islands
from chronofold.operators.intervals import RUN, _bucket, _level, islands, overlap_join
from chronofold.operators.ordered import match, with_bucket


def half_cauchy(x: Column, scale: Column) -> Column:
    """Density of the half Cauchy distribution: 0 below 0, null for a scale that is not positive."""
    dense = F.lit(2.0) / (math.pi * scale * (1 + F.pow(x / scale, 2)))
    return F.when(scale <= 0, F.lit(None)).when(x < 0, 0.0).otherwise(dense)


#: Long windows are dealt to DEALT groups a bucket by the peaks in them; BLOCK pairs are compared at a time.
DEALT, BLOCK = 16, 1 << 18


@dataclass
class Side:
    """Rows of one side in a bucket, by time: [time, end) (of a peak its window), centre, key, and the numbers asked for, NaN for null."""

    time: np.ndarray
    end: np.ndarray
    centre: np.ndarray
    key: np.ndarray | None
    numbers: dict[str, np.ndarray]

    def __getitem__(self, name: str) -> np.ndarray:
        return self.numbers[name]

    def cut(self, rows, shape=slice(None)) -> Side:
        pick = lambda v: None if v is None else v[rows][shape]
        return Side(pick(self.time), pick(self.end), pick(self.centre), pick(self.key), {n: pick(v) for n, v in self.numbers.items()})


def blocks(peaks: Side, casting: Side):
    """(rows, p, c, touching) over all that may touch: p is a column of peaks, c a row of casting peaks, both cut from their sides; never over BLOCK pairs at once."""
    if not len(peaks.time) or not len(casting.time):
        return
    reach = np.maximum.accumulate(casting.end)
    step = 256
    for i in range(0, len(peaks.time), step):
        rows = slice(i, i + step)
        p = peaks.cut(rows, (slice(None), None))
        first, last = np.searchsorted(reach, p.time.min(), side="right"), np.searchsorted(casting.time, p.end.max(), side="left")
        for j in range(first, last, BLOCK // step):
            c = casting.cut(slice(j, min(j + BLOCK // step, last)), (None, slice(None)))
            yield rows, p, c, (c.time < p.end) & (p.time < c.end)


def _met(
    peaks: DataFrame, casting: DataFrame, back: int, ahead: int, score: Callable[[Side, Side], dict[str, np.ndarray]], out: dict[str, str],
    merge: dict[str, Column], key: str, by: Sequence[str], carry: Sequence[str], numbers: Sequence[str],
) -> DataFrame:
    """(by, w_key, columns of merge): what score finds of each peak's window, [centre - back, centre + ahead), among the casting peaks that touch it.

    Both sides go by time buckets as wide as the window, casting peaks with a copy in each that they reach, long ones in wider buckets; score gets both sides of
    one bucket, sorted by time, as columns, and judges pairs by the block: no pair is a row. Its results (columns of out) are partial ones of a peak, of
    each width of bucket, which merge combines; of them n, the number of pairs found, must be over 0.
    """
    width = max(back + ahead, 2)
    doubles = lambda df, cols, names: [F.col(c).cast("double").alias(f"_n_{c}") if c in cols else F.lit(None).cast("double").alias(f"_n_{c}") for c in names]
    every = [*carry, *[n for n in numbers if n not in carry]]
    long, kind = lambda c: F.col(c).cast("long"), peaks.schema[key].dataType
    keyed = "ck" in casting.columns
    own_key = F.col("ck").cast(kind) if keyed else F.lit(None).cast(kind)
    cast = casting.where("time is not null and endtime is not null and c is not null")
    cast = cast.select(*by, long("time").alias("time"), long("endtime").alias("endtime"), long("c").alias("_c"), own_key.alias(f"w_{key}"), *doubles(cast, numbers, every), F.lit(0).alias("_side"))
    cast = cast.withColumn("_level", _level("time", "endtime", width))
    top = F.coalesce(cast.agg(F.max("_level").alias("top")).scalar(), F.lit(0))
    cast = cast.withColumns({"_from": F.col("time") - ahead, "_to": F.greatest("time", "endtime") + back})
    cast = cast.withColumn("_bucket", F.explode(F.sequence(_bucket("_from", "_level", width), _bucket("_to", "_level", width)))).drop("_from", "_to")
    cast = cast.withColumn("_deal", F.explode(F.when(F.col("_level") == 0, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.lit(DEALT - 1)))))
    ct = long("center_time")
    asked = peaks.where("center_time is not null").select(*by, (ct - back).alias("time"), (ct + ahead).alias("endtime"), ct.alias("_c"), F.col(key).alias(f"w_{key}"), *doubles(peaks, carry, every), F.lit(1).alias("_side"))
    asked = asked.withColumn("_level", F.explode(F.sequence(F.lit(0), top))).withColumn("_bucket", _bucket("_c", "_level", width))
    asked = asked.withColumn("_deal", F.when(F.col("_level") == 0, 0).otherwise(F.pmod(F.xxhash64("_c"), F.lit(DEALT)).cast("int")))
    both = cast.unionByName(asked.select(cast.columns))
    fields = [*[both.schema[c] for c in (*by, f"w_{key}")], *[StructField(n, LongType() if t == "long" else DoubleType()) for n, t in out.items()]]

    def kernel(batch: pa.RecordBatch, starts: np.ndarray) -> pa.RecordBatch:
        ints = lambda c: batch.column(c).to_numpy(zero_copy_only=False)
        side, cols = ints("_side"), [ints(c) for c in ("time", "endtime", "_c")]
        keys = ints(f"w_{key}") if keyed else None
        values = {c: floats(batch, f"_n_{c}") for c in every}
        rows, found = [], {n: [] for n in out}
        for a, b in zip(starts, np.append(starts[1:], batch.num_rows)):
            m = a + int(np.searchsorted(side[a:b], 1))
            if m == a or m == b:
                continue  # one side only
            part = lambda u, v, names: Side(*[c[u:v] for c in cols], None if keys is None else keys[u:v], {n: values[n][u:v] for n in names})
            got = score(part(m, b, carry), part(a, m, numbers))
            rows.append(np.arange(m, b))
            for n in out:
                found[n].append(got[n])
        at = pa.array(np.concatenate(rows) if rows else np.array([], dtype=np.int64))
        joined = [pa.array(np.concatenate(found[n]) if rows else np.array([]), pa.int64() if t == "long" else pa.float64()) for n, t in out.items()]
        return pa.RecordBatch.from_arrays([*(batch.column(c).take(at) for c in (*by, f"w_{key}")), *joined], names=[*by, f"w_{key}", *out])

    parts = map_islands(both, kernel, StructType(fields), ("_side", "time"), [*by, "_level", "_bucket"], "_deal").where("n > 0")
    return parts.groupBy(*by, f"w_{key}").agg(*[c.alias(n) for n, c in merge.items()])


def _attached(peaks: DataFrame, found: DataFrame, key: str, zeros: dict[str, Column], by: Sequence[str]) -> DataFrame:
    out = match(peaks.select(*by, key), found.withColumnRenamed(f"w_{key}", key), [*by, key], "left")
    return out.select(*by, key, *[F.coalesce(F.col(n), v).alias(n) for n, v in zeros.items()])


def _power(x: np.ndarray, exponent: float) -> np.ndarray:
    return x if exponent == 1 else 1 / x if exponent == -1 else np.power(x, exponent)


def above(values: np.ndarray, upto: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """How many of the first upto[i] values exceed limits[i], by a wavelet matrix: a pass over values and questions for each bit of a rank."""
    order = np.argsort(values, kind="stable")
    ranks = np.empty(len(values), dtype=np.int64)
    ranks[order] = np.arange(len(values))
    least = np.searchsorted(values[order], limits, side="right")
    low, high, found = np.zeros(len(upto), dtype=np.int64), upto.astype(np.int64), np.zeros(len(upto), dtype=np.int64)
    for b in reversed(range(len(values).bit_length())):
        one = (ranks >> b) & 1
        zeros = np.concatenate([[0], np.cumsum(1 - one)])
        a, z = zeros[low], zeros[high]
        up = ((least >> b) & 1) == 1
        found += np.where(up, 0, (high - low) - (z - a))
        low, high = np.where(up, zeros[-1] + low - a, a), np.where(up, zeros[-1] + high - z, z)
        ranks = np.concatenate([ranks[one == 0], ranks[one == 1]])
    return found + high - low


def _competing(fraction: float, p: Side, c: Side) -> dict[str, np.ndarray]:
    n, left = np.zeros(len(p.time), dtype=np.int64), np.zeros(len(p.time), dtype=np.int64)
    limit = p["area"] * fraction
    if len(p.time) * len(c.time) > 1 << 16:
        # Of peaks with their centre inside, those that are over before the window have begun before its end, so two counts each are enough.
        plain = (c.time <= c.centre) & (c.centre <= c.end) & (p.time[0] < p.centre[0] < p.end[0])
        begin, centre, end = (np.argsort(v[plain], kind="stable") for v in (c.time, c.centre, c.end))
        a = c["a"][plain]
        over = above(a[end], np.searchsorted(c.end[plain][end], p.time, side="right"), limit)
        n += above(a[begin], np.searchsorted(c.time[plain][begin], p.end, side="left"), limit) - over
        left += above(a[centre], np.searchsorted(c.centre[plain][centre], p.centre, side="left"), limit) - over
        c = c.cut(~plain)
    for rows, q, d, met in blocks(p, c):
        met &= (d["a"] > q["area"] * fraction) | (np.isnan(d["a"]) & ~np.isnan(q["area"]))
        n[rows] += met.sum(axis=1)
        left[rows] += (met & (d.centre < q.centre)).sum(axis=1)
    return {"n": n, "left": left}


def competing(peaks: DataFrame, window: int, fraction: float = 0.2, types: Sequence[int] = (1, 2), key: str = "hit_id", by: Sequence[str] = RUN) -> DataFrame:
    """(by, key, n_competing_left, n_competing): peaks of the types within the window whose area is over fraction of one's own; a peak
    of such a type counts itself in n_competing."""
    casting = peaks.where(F.col("type").isin(*types) & F.col("area").isNotNull()).select(*by, "time", "endtime", F.col("center_time").alias("c"), F.col("area").alias("a"))
    merge = {"n_competing_left": F.sum("left"), "n_competing": F.sum("n")}
    found = _met(peaks, casting, window, window, partial(_competing, fraction), {"n": "long", "left": "long"}, merge, key, by, ["area"], ["a"])
    zero = F.lit(0).cast("long")
    return _attached(peaks, found, key, {"n_competing_left": zero, "n_competing": zero}, by)


def _proximity(exponents: Sequence[float], sigma: float, fraction: float, p: Side, c: Side) -> dict[str, np.ndarray]:
    n, total = np.zeros(len(p.time), dtype=np.int64), np.zeros(len(p.time))
    for rows, q, d, met in blocks(p, c):
        met &= (d.centre < q.centre) & (d["a"] >= q["area"] * fraction) & ~np.isnan(d["cx"] + d["cy"]) & ~np.isnan(q["x"] + q["y"])
        with np.errstate(all="ignore"):
            dr, scale = np.hypot(q["x"] - d["cx"], q["y"] - d["cy"]), sigma * np.sqrt(1 / d["a"] + 1 / q["area"])
            pdf = 2 / (math.pi * scale * (1 + (dr / scale) ** 2))
            score = _power(d["a"] / q["area"], exponents[0]) * _power((q.centre - d.centre) / 1e6, exponents[1]) * _power(pdf, exponents[2])
        total[rows] += np.where(met, np.where(dr == 0, np.inf, score), 0).sum(axis=1)
        n[rows] += met.sum(axis=1)
    return {"n": n, "score": total}


def proximity(
    peaks: DataFrame, window: int, exponents: Sequence[float] = (1.0, -1.0, 1.0), sigma: float = 22.0, fraction: float = 0.2,
    types: Sequence[int] = (1, 2), key: str = "hit_id", by: Sequence[str] = RUN,
) -> DataFrame:
    """(by, key, proximity_score): sum over earlier peaks of r^e0 * dt_ms^e1 * halfCauchy(dr)^e2; infinite if one is at the same place."""
    casting = peaks.where(F.col("type").isin(*types) & (F.col("area") > 0))
    casting = casting.select(*by, "time", "endtime", F.col("center_time").alias("c"), F.col("area").alias("a"), F.col("x").alias("cx"), F.col("y").alias("cy"))
    score = partial(_proximity, tuple(exponents), sigma, fraction)
    found = _met(peaks.where("area > 0"), casting, window, 0, score, {"n": "long", "score": "double"}, {"proximity_score": F.sum("score")}, key, by, ["area", "x", "y"], ["a", "cx", "cy"])
    return _attached(peaks, found, key, {"proximity_score": F.lit(0.0)}, by)


#: Stands for a place that is null, as NaN is one that is not a number.
NOWHERE = float("-inf")


def _shadow(exponent: float, position: bool, sigma: Sequence[float], radius: float, p: Side, c: Side) -> dict[str, np.ndarray]:
    """Of each peak: n, the sums of value and of dt^e; the greatest value and where it comes from (of equals the earliest); the nearest casting
    peak (of equals the largest key). A value that cannot be told is below all others."""
    m = len(p.time)
    out = {n: np.zeros(m, dtype=np.int64) for n in ("n", "c", "ndt", "nk")} | {n: np.zeros(m) for n in ("s", "f", "x", "y", "na")} | {"v": np.full(m, -np.inf)}
    last = np.iinfo(np.int64).max
    out["c"][:], out["ndt"][:] = last, last
    high = lambda v: np.where(np.isnan(v), np.inf, v)
    for rows, q, d, met in blocks(p, c):
        turn = np.lexsort((-high(d["cy"][0]), -high(d["cx"][0]), d.centre[0]))  # of equal values argmax takes the first
        d, met = d.cut((slice(None), turn)), met[:, turn]
        met &= d.centre < q.centre
        with np.errstate(all="ignore"):
            dt = (q.centre - d.centre).astype(np.float64)
            ft = _power(dt, exponent)
            value = d["a"] * ft
            if position:
                dist = np.hypot(q["x"] - d["cx"], q["y"] - d["cy"])
                dist = np.where(np.isfinite(dist), dist, 2 * radius)
                scale = sigma[0] / np.sqrt(q["area"]) + sigma[1]
                value = value * (2 / (math.pi * scale * (1 + (dist / scale) ** 2)))
        some = met.any(axis=1)
        got = {n: v[rows] for n, v in out.items()}  # views
        got["n"] += met.sum(axis=1)
        got["s"] += np.where(met, value, 0).sum(axis=1)
        got["f"] += np.where(met, ft, 0).sum(axis=1)
        judged = np.where(met, np.nan_to_num(value, nan=np.finfo(float).min, posinf=np.inf), -np.inf)
        at = judged.argmax(axis=1)
        v, cc, x, y = judged[np.arange(len(at)), at], d.centre[0][at], d["cx"][0][at], d["cy"][0][at]
        new, old = (v, -cc, high(x), high(y)), (got["v"], -got["c"], high(got["x"]), high(got["y"]))
        better = np.zeros(len(at), dtype=bool)
        for u, w in reversed(list(zip(new, old))):
            better = (u > w) | ((u == w) & better)
        better &= some
        for n, w in (("v", v), ("c", cc), ("x", x), ("y", y)):
            got[n][better] = w[better]
        rank = np.empty(len(turn), dtype=np.int64)
        rank[np.lexsort((-d["a"][0], d.key[0], d.centre[0]))] = np.arange(len(turn))
        at = np.where(met, rank, -1).argmax(axis=1)
        ndt, nk, na = q.centre[:, 0] - d.centre[0][at], d.key[0][at], d["a"][0][at]
        nearer = some & ((ndt < got["ndt"]) | ((ndt == got["ndt"]) & ((nk > got["nk"]) | ((nk == got["nk"]) & (na < got["na"])))))
        for n, w in (("ndt", ndt), ("nk", nk), ("na", na)):
            got[n][nearer] = w[nearer]
    return out


def shadow(
    peaks: DataFrame, window: int, min_area: float, casting_type: int, exponent: float = -1.0, position: bool = False, as_sum: bool = False,
    sigma: Sequence[float] = (15.0, 0.0), radius: float = 66.4, key: str = "hit_id", by: Sequence[str] = RUN,
) -> DataFrame:
    """(by, key, shadow, dt, x, y, nearest, nearest_dt): the earlier large peak with the greatest area * dt^e (times the half-Cauchy
    density of the distance if ``position``), or their sum; without one the shadow of a peak just under the threshold at the window's edge."""
    if position and as_sum:
        raise ValueError("a position shadow cannot be summed")
    casting = peaks.where((F.col("type") == casting_type) & (F.col("area") > min_area))
    place = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(NOWHERE)).alias(f"c{c}")
    casting = casting.select(*by, "time", "endtime", F.col("center_time").alias("c"), F.col("area").alias("a"), place("x"), place("y"), F.col(key).alias("ck"))
    near = F.min(F.struct(F.col("ndt").alias("dt"), (-F.col("nk")).alias("k"), F.col("na").alias("a")))
    edge = min_area * float(window) ** exponent
    out = {"n": "long", "c": "long", "ndt": "long", "nk": "long", "s": "double", "f": "double", "x": "double", "y": "double", "na": "double", "v": "double"}
    if as_sum:
        nothing = F.first(F.lit(None).cast("double"))
        merge = {"shadow": F.sum("s"), "dt": F.sum("n") * F.pow(F.sum("f"), 1 / exponent), "x": nothing, "y": nothing, "near": near}
    else:
        merge = {"best": F.max(F.struct("v", (-F.col("c")).alias("c"), "x", "y")), "near": near}
    score = partial(_shadow, exponent, position, tuple(sigma), radius)
    found = _met(peaks, casting, window, 0, score, out, merge, key, by, ["area", "x", "y"], ["a", "cx", "cy"])
    if not as_sum:
        told = lambda c: F.when(F.col(f"best.{c}") != NOWHERE, F.col(f"best.{c}")).alias(c)
        value = F.when(F.col("best.v") > float(np.finfo(float).min), F.col("best.v")).alias("shadow")
        found = found.select(*by, f"w_{key}", value, (-F.col("best.c")).alias("c"), told("x"), told("y"), "near")
    late = F.lit(None).cast("long").alias("c") if as_sum else F.col("c")
    found = found.select(*by, F.col(f"w_{key}").alias(key), "shadow", F.col("dt") if as_sum else F.lit(None).cast("double").alias("dt"), late, "x", "y", F.col("near.a").alias("nearest"), F.col("near.dt").alias("nearest_dt"))
    rows = match(peaks.select(*by, key, F.col("center_time").alias("_ct")), found, [*by, key], "left")
    dt = F.coalesce("dt", (F.col("_ct") - F.col("c")).cast("double"), F.lit(float(window)))
    return rows.select(*by, key, F.coalesce("shadow", F.lit(edge)).alias("shadow"), dt.alias("dt"), "x", "y", "nearest", "nearest_dt")


def _close(a: np.ndarray, b: np.ndarray, distance: float) -> bool:
    """Whether a place of a and one of b (rows of x, y) are at most ``distance`` apart; only those near the other's box are compared, a block at a time."""
    for one, two in ((0, 1), (1, 0)):
        p, q = (a, b) if one == 0 else (b, a)
        p = p[np.all((p >= q.min(axis=0) - distance) & (p <= q.max(axis=0) + distance), axis=1)]
        if not len(p):
            return False
        a, b = (p, q) if one == 0 else (q, p)
    for i in range(0, len(a), 512):
        for j in range(0, len(b), 512):
            u, v = a[i : i + 512, None], b[None, j : j + 512]
            if np.any(np.hypot(u[..., 0] - v[..., 0], u[..., 1] - v[..., 1]) <= distance):
                return True
    return False


def linked_places(x: np.ndarray, y: np.ndarray, distance: float) -> np.ndarray:
    """For each point the first point of its connected component, where points at most ``distance`` apart are linked. Points of one cell of a
    grid are always that near, so cells are linked, not points: two cells by the first near pair found. Points without a place are alone."""
    first = np.arange(len(x))
    placed = np.flatnonzero(np.isfinite(x) & np.isfinite(y))
    if not len(placed):
        return first
    points = np.column_stack([x[placed], y[placed]])
    grid = np.floor(points / (distance / 1.5))
    cells, cell = np.unique(grid, axis=0, return_inverse=True)
    cell = cell.ravel()
    order = np.argsort(cell, kind="stable")
    ends = np.cumsum(np.bincount(cell, minlength=len(cells)))
    members = np.split(order, ends[:-1])
    parent = list(range(len(cells)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    number = {c: i for i, c in enumerate(map(tuple, cells.tolist()))}
    # Near cells first: most of those farther away are linked through them by then.
    steps = sorted(((u, v) for u in range(-2, 3) for v in range(-2, 3) if (u, v) > (0, 0)), key=lambda s: s[0] ** 2 + s[1] ** 2)
    for u, v in steps:
        for (cx, cy), i in number.items():
            j = number.get((cx + u, cy + v))
            if j is not None and (r := root(i)) != (t := root(j)) and _close(points[members[i]], points[members[j]], distance):
                parent[max(r, t)] = min(r, t)
    group = np.array([root(i) for i in range(len(cells))])[cell]
    least = np.full(len(cells), len(x))
    np.minimum.at(least, group, placed)
    first[placed] = least[group]
    return first


def casting_clusters(peaks: DataFrame, gap: int, distance: float = 0.0, key: str = "hit_id", by: Sequence[str] = RUN, width: int = ordered.HOUR) -> DataFrame:
    """(by, key, cluster): the key of the first peak, by centre, of each peak's cluster. Peaks whose centres follow each other within gap are a time
    cluster; with a distance it falls apart into the connected components of peaks at most that far apart. Peaks of one place are one to the task that holds
    an island."""
    rows = peaks.select(*by, key, F.col("center_time").alias("time"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    marked = islands(rows, "time", gap, by, ("time", key), max(width, gap))
    if distance <= 0:
        first = F.min(F.struct("time", key)).over(Window.partitionBy(*by, "island"))
        return marked.select(*by, key, first[key].alias("cluster"))

    def kernel(batch: pa.RecordBatch, starts: np.ndarray) -> pa.RecordBatch:
        x, y, first = floats(batch, "x"), floats(batch, "y"), np.arange(batch.num_rows)
        ends = np.append(starts[1:], batch.num_rows)
        for a, b in zip(starts[ends - starts > 1], ends[ends - starts > 1]):
            first[a:b] = a + linked_places(x[a:b], y[a:b], distance)
        firsts = batch.column(key).take(pa.array(first))
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in (*by, "island", "x", "y")), firsts], names=[*by, "island", "x", "y", "cluster"])

    on = [*by, "island", "x", "y"]
    somewhere = F.col("x").isNotNull() & F.col("y").isNotNull() & ~F.isnan("x") & ~F.isnan("y")
    places = marked.where(somewhere).groupBy(*on).agg(F.min(F.struct("time", key)).alias("_first")).select(*on, "_first.*")
    out = StructType([*[places.schema[c] for c in on], StructField("cluster", marked.schema[key].dataType)])
    found = match(marked, map_islands(places, kernel, out, ("time", key), by), on, "left")
    return found.select(*by, key, F.coalesce("cluster", key).alias("cluster"))


def merge_casting(
    peaks: DataFrame, gap: int, distance: float, weight: Column | None = None, last: bool = True, replace: bool = True, key: str = "hit_id", by: Sequence[str] = RUN, width: int = ordered.HOUR
) -> DataFrame:
    """(by, key, time, endtime, center_time, area, x, y, type, n_merged): casting peaks with those of a cluster made one.

    Areas add up, the span covers all; the centre is the last one's (``last``) or the area-weighted mean; places are weighed by ``weight`` (the area where not
    given), and where a weight is infinite only those places count. key and type are the first one's. replace: the parts are gone; otherwise they stay beside
    the merged peak. Every clustered peak is merged with its own cluster; a run of close peaks begins with its first peak.
    """
    rows = match(peaks.withColumn("_w", (weight if weight is not None else F.col("area")).cast("double")), casting_clusters(peaks, gap, distance, key, by, width), [*by, key])
    order, infinite = F.struct("center_time", key), F.col("_w") == float("inf")
    place = lambda c: F.when(F.bool_or(infinite), F.avg(F.when(infinite, F.col(c)))).otherwise(F.try_divide(F.sum(F.col(c) * F.col("_w")), F.sum(F.when(F.col(c).isNotNull(), F.col("_w")))))
    mean = F.round(F.try_divide(F.sum(F.col("center_time").cast("double") * F.col("area")), F.sum("area"))).cast("long")
    centre = F.max("center_time") if last else F.coalesce(mean, F.max("center_time"))
    found = rows.groupBy(*by, "cluster").agg(
        F.min("time").alias("time"), F.max("endtime").alias("endtime"), centre.alias("center_time"), F.sum("area").alias("area"), place("x").alias("x"), place("y").alias("y"),
        F.min_by("type", order).alias("type"), F.count(F.lit(1)).alias("n_merged"), F.first("x").alias("_x"), F.first("y").alias("_y"),
    )
    alone = F.col("n_merged") == 1
    found = found.withColumns({"x": F.when(alone, F.col("_x")).otherwise(F.col("x")), "y": F.when(alone, F.col("_y")).otherwise(F.col("y"))}).withColumnRenamed("cluster", key)
    names = [*by, key, "time", "endtime", "center_time", "area", "x", "y", "type", "n_merged"]
    if replace:
        return found.select(names)
    parts = peaks.withColumn("n_merged", F.lit(1).cast("long")).select(names)
    return parts.unionByName(found.where(~alone).select(names))


#: The type that lone hits have among casting peaks.
LONE = -1


def _ambience(kinds: Sequence[int], radius: float, exponents: Sequence[float], p: Side, c: Side) -> dict[str, np.ndarray]:
    m = len(p.time)
    counts, sums, n_near, near = np.zeros((m, len(kinds))), np.zeros((m, len(kinds))), np.zeros(m, dtype=np.int64), np.zeros(m)
    for rows, q, d, met in blocks(p, c):
        met &= d.centre < q.centre
        mine = (d["type"][0][:, None] == np.array(kinds)).astype(float)
        with np.errstate(all="ignore"):
            s = np.where(met, np.nan_to_num(d["a"]) * _power((q.centre - d.centre).astype(np.float64), exponents[0]), 0)
        counts[rows] += met @ mine
        sums[rows] += s @ mine
        second = np.flatnonzero(d["type"][0] == 2)
        if len(second):
            with np.errstate(all="ignore"):
                dr = np.hypot(q["x"] - d["cx"][:, second], q["y"] - d["cy"][:, second])
                close = met[:, second] & (dr <= radius)
                near[rows] += np.where(close, np.where(dr > 0, s[:, second] * _power(dr, exponents[1]), np.inf), 0).sum(axis=1)
            n_near[rows] += close.sum(axis=1)
    out = {"n": counts.sum(axis=1).astype(np.int64), "n_near": n_near, "s_near": near}
    for i, k in enumerate(kinds):
        out |= {f"n_{k}": counts[:, i].astype(np.int64), f"s_{k}": sums[:, i]}
    return out


def ambience(
    peaks: DataFrame, lone_hits: DataFrame, window: int, max_area: dict[int, float], radius: float, gains: DataFrame | None = None,
    exponents: Sequence[float] = (-1.0, -1.0), key: str = "hit_id", by: Sequence[str] = RUN,
) -> DataFrame:
    """Numbers (n_) and sums of area * dt^e (s_) of lone hits and of small peaks of each type before a peak, and of type 2 nearby."""
    hits = lone_hits.where("area > 0").select(*by, "time", "endtime", F.col("time").alias("c"), F.col("area").cast("double").alias("a"), F.lit(LONE).alias("type"), "channel")
    if gains is not None:
        hits = hits.join(gains, "channel").withColumn("a", F.col("a") * F.col("gain"))
    small = None
    for kind, area in max_area.items():
        test = (F.col("type") == kind) & (F.col("area") < area)
        small = test if small is None else small | test
    casting = peaks.where(small).select(*by, "time", "endtime", F.col("center_time").alias("c"), F.col("area").cast("double").alias("a"), "type", F.col("x").cast("double").alias("cx"), F.col("y").cast("double").alias("cy"))
    nowhere = F.lit(None).cast("double")
    casting = casting.unionByName(hits.drop("channel").select(*by, "time", "endtime", "c", "a", "type", nowhere.alias("cx"), nowhere.alias("cy")))
    kinds, out, merge = (LONE, *max_area), {"n": "long", "n_near": "long", "s_near": "double"}, {"n_lh_before": F.sum(f"n_{LONE}"), "s_lh_before": F.sum(f"s_{LONE}")}
    for kind in kinds:
        out |= {f"n_{kind}": "long", f"s_{kind}": "double"}
    for kind in max_area:
        merge |= {f"n_s{kind}_before": F.sum(f"n_{kind}"), f"s_s{kind}_before": F.sum(f"s_{kind}")}
    merge |= {"n_s2_near": F.sum("n_near"), "s_s2_near": F.sum("s_near")}
    found = _met(peaks, casting, window, 0, partial(_ambience, kinds, radius, tuple(exponents)), out, merge, key, by, ["x", "y"], ["a", "type", "cx", "cy"])
    names = list(merge)
    out = _attached(peaks, found, key, {n: F.lit(0).cast("long") if n.startswith("n_") else F.lit(0.0) for n in names}, by)
    total = sum((F.col(n) for n in names if n.startswith("s_") and n.endswith("_before")), F.lit(0.0))
    return out.withColumn("s_before", total)


def _se_score(a: float, b: float, p: Side, c: Side) -> dict[str, np.ndarray]:
    n, total = np.zeros(len(p.time), dtype=np.int64), np.zeros(len(p.time))
    for rows, q, d, met in blocks(p, c):
        with np.errstate(all="ignore"):
            spread = (a / np.sqrt(d["a"]) + b) ** 2 + (a / np.sqrt(q["area"]) + b) ** 2
            d2 = (q["x"] - d["cx"]) ** 2 + (q["y"] - d["cy"]) ** 2
            score = np.exp(-d2 / (2 * spread)) / (2 * math.pi * spread)
        total[rows] += np.where(met & ~np.isnan(score), score, 0).sum(axis=1)
        n[rows] += met.sum(axis=1)
    return {"n": n, "score": total}


def se_score(
    peaks: DataFrame, electrons: DataFrame, left: int, right: int = 0, a: float = 1.0, b: float = 0.1, key: str = "hit_id", by: Sequence[str] = RUN
) -> DataFrame:
    """(by, key, se_score): summed 2-D normal densities of single electrons around a peak, widths a/sqrt(area) + b combined; peaks without a
    place get null."""
    casting = electrons.select(*by, "time", "endtime", F.col("time").alias("c"), F.col("area").alias("a"), F.col("x").alias("cx"), F.col("y").alias("cy"))
    asked, out = peaks.where("x is not null and y is not null"), {"n": "long", "score": "double"}
    found = _met(asked, casting, left, right, partial(_se_score, a, b), out, {"se_score": F.sum("score")}, key, by, ["area", "x", "y"], ["a", "cx", "cy"])
    out = match(peaks.select(*by, key, "x", "y"), found.withColumnRenamed(f"w_{key}", key), [*by, key], "left")
    return out.select(*by, key, F.when(F.col("x").isNotNull() & F.col("y").isNotNull(), F.coalesce("se_score", F.lit(0.0))).alias("se_score"))


def tight_coincidence(peaks: DataFrame, hits: DataFrame, left: int, right: int, key: str = "peak_id", by: Sequence[str] = RUN, width: int = ordered.HOUR) -> DataFrame:
    """(by, key, tight_coincidence): distinct channels with a hit in [time - left, time + right].

    All windows are equally long. A channel counts in the windows that begin at most that long before one of its hits: spans, disjoint in each channel
    once joined. So the number is that of the spans begun less that of those over at a window's begin, running sums over all channels, without pairs.
    """
    size = left + right
    if size < 0:
        return peaks.select(*by, key, F.lit(0).cast("long").alias("tight_coincidence"))
    seen = hits.where(F.col("channel").isNotNull() & F.col("time").isNotNull()).select(*by, "channel", F.col("time").cast("long").alias("time")).distinct()
    seen = ordered.neighbours(seen, ["time"], ["time"], [*by, "channel"], ("time",), 24 * max(width, size))
    begins = F.when(F.col("prev_time").isNull() | (F.col("time") - F.col("prev_time") > size), F.struct((F.col("time") - size).alias("time"), F.lit(1).cast("long").alias("_step")))
    over = F.when(F.col("next_time").isNull() | (F.col("next_time") - F.col("time") > size), F.struct((F.col("time") + 1).alias("time"), F.lit(-1).cast("long").alias("_step")))
    steps = seen.select(*by, F.explode(F.array_compact(F.array(begins, over))).alias("_s")).select(*by, "_s.*").groupBy(*by, "time").agg(F.sum("_step").alias("_step"))
    asked = peaks.select(*by, (F.col("time").cast("long") - left).alias("time"), key)
    # At equal times the steps stand before the windows.
    both = asked.withColumns({"_step": F.lit(0).cast("long"), "_asks": F.lit(1)}).unionByName(steps.withColumns({key: F.lit(None).cast(peaks.schema[key].dataType), "_asks": F.lit(0)}))
    found = ordered.running_sum(both, "_step", "tight_coincidence", by, ("time", "_asks"), max(width, size)).where("_asks = 1")
    return found.select(*by, key, F.when(F.col("time").isNull(), F.lit(0).cast("long")).otherwise(F.col("tight_coincidence")).alias("tight_coincidence"))


def hits_per_peak(peaks: DataFrame, hits: DataFrame, key: str = "peak_id", by: Sequence[str] = RUN, width: int = 3600 * 10**9) -> DataFrame:
    """(by, key, n_hits): hits that overlap the peak."""
    met = overlap_join(hits.select(*by, "time", "endtime"), peaks.select(*by, "time", "endtime", key), by, width)
    found = met.groupBy(*by, f"w_{key}").agg(F.count(F.lit(1)).alias("n_hits"))
    return _attached(peaks, found, key, {"n_hits": F.lit(0).cast("long")}, by)


def count_in_range(df: DataFrame, back: int, key: str = "hit_id", by: Sequence[str] = RUN) -> DataFrame:
    """(by, key, n_before): rows in the ``back`` nanoseconds before each row, by a RANGE frame per bucket with a halo."""
    rows = with_bucket(df.select(*by, "time", key), max(back, 1)).withColumn("_own", F.lit(True))
    halo = rows.withColumn("_bucket", F.col("_bucket") + 1).withColumn("_own", F.lit(False))
    w = Window.partitionBy(*by, "_bucket").orderBy("time").rangeBetween(-back, -1)
    return rows.unionByName(halo).withColumn("n_before", F.count(F.lit(1)).over(w)).where("_own").select(*by, key, "n_before")
