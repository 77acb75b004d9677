"""Interval algebra: every row is a half-open interval [time, endtime) in integer nanoseconds.

Joins on intervals run as equi-joins on time buckets, never as nested loops: an interval is copied into the few
buckets that it touches at the level of its length, and a pair found in several buckets is kept in one, the result is exact for any bucket width. Runs of a common key (default run_id) never meet; ids need to be unique in a run only.
Rows without a run are a run of their own, in joins too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronofold.operators import ordered
from chronofold.operators.ordered import HOUR, before_part, match, parted, with_bucket, within_part

RUN = ("run_id",)


def with_endtime(df: DataFrame) -> DataFrame:
    """endtime = time + length * dt, for rows that carry a length and a sample width."""
    return df.withColumn("endtime", F.col("time") + F.col("length").cast("long") * F.col("dt").cast("long"))


def in_channels(channel: Column, first: int, last: int) -> Column:
    return channel.between(first, last)


def route_channels(df: DataFrame, ranges: dict[str, tuple[int, int]], channel: str = "channel", drop_suffix: str = "blank") -> DataFrame:
    """Adds ``detector`` by inclusive channel range; rows of ranges that end in drop_suffix go, unknown channels raise."""
    case = None
    for name, (first, last) in ranges.items():
        hit = F.col(channel).between(first, last)
        case = F.when(hit, name) if case is None else case.when(hit, name)
    lost = F.raise_error(F.concat(F.lit("no detector has channel "), F.col(channel).cast("string"))).cast("string")
    routed = df.withColumn("detector", case.otherwise(lost))
    return routed.where(~F.col("detector").endswith(drop_suffix))


def select_time(df: DataFrame, start: int, end: int, mode: str = "fully_contained") -> DataFrame:
    """Rows inside [start, end): fully_contained, touching, or skip (all rows). The predicates reach the scan."""
    if mode == "fully_contained":
        return df.where((F.col("time") >= start) & (F.col("endtime") <= end))
    if mode == "touching":
        return df.where((F.col("endtime") > start) & (F.col("time") < end))
    if mode == "skip":
        return df
    raise ValueError(f"unknown selection {mode!r}")


#: An interval is copied at the level where it touches at most a few buckets; each level's buckets are FAN times as wide.
FAN, LEVELS = 64, 6


def _widths(width: int) -> list[int]:
    return [width * FAN**k for k in range(LEVELS) if width * FAN**k < 1 << 62]


def _level(start: str, end: str, width: int) -> Column:
    """The level of an interval: the first whose buckets are at least a quarter as wide as it is long."""
    size = F.col(end) - F.col(start)
    out = F.lit(len(_widths(width)) - 1)
    for k, w in reversed(list(enumerate(_widths(width)[:-1]))):
        out = F.when(size <= 4 * w, k).otherwise(out)
    return out


def _bucket(time: str, level: str, width: int) -> Column:
    w = F.element_at(F.array(*[F.lit(x).cast("long") for x in _widths(width)]), F.col(level) + 1)
    return F.floor(F.col(time) / w).cast("long") if width == 1 else F.call_function("div", F.col(time) - F.pmod(F.col(time), w), w)


def _spread(df: DataFrame, start: str, end: str, width: int, top: Column | None = None) -> DataFrame:
    """One copy of each row per bucket that [start, end] touches, at its own level and, with top, at all levels up to it."""
    own = df.withColumn("_own", _level(start, end, width))
    own = own.withColumn("_level", F.explode(F.sequence("_own", F.greatest("_own", top))) if top is not None else F.col("_own"))
    first, last = _bucket(start, "_level", width), _bucket(end, "_level", width)
    return own.withColumn("_bucket", F.explode(F.sequence(first, F.greatest(first, last))))


def overlap_join(
    things: DataFrame, windows: DataFrame, by: Sequence[str] = RUN, width: int = HOUR, how: str = "touching", prefix: str = "w_"
) -> DataFrame:
    """Pairs of a thing and a window: touching (t.time < w.end and w.time < t.end), contained (thing inside window) or
    starting (t.time in [w.time, w.end]). Window columns other than ``by`` get the prefix.

    A row is copied into the few buckets that it touches at the level of its length, so one that lasts a whole run costs no more
    copies than a short one; levels that no row of the other side has are left out (a scalar subquery finds the highest).
    """
    w = windows.select(*by, *[F.col(c).alias(f"{prefix}{c}") for c in windows.columns if c not in by])
    ws, we = f"{prefix}time", f"{prefix}endtime"
    highest = lambda df, a, b: F.coalesce(df.agg(F.max(_level(a, b, width)).alias("top")).scalar(), F.lit(0))
    top = highest(w, ws, we)
    if how == "touching":
        test = (F.col("time") < F.col(we)) & (F.col(ws) < F.col("endtime"))
        left = _spread(things, "time", "endtime", width, top)
        right = _spread(w, ws, we, width, highest(things, "time", "endtime")).withColumnRenamed("_own", "_w_own")
        # A pair meets at the higher of both levels, in every bucket that both touch; the bucket of the later start is its own.
        once = (F.col("_level") == F.greatest("_own", "_w_own")) & (F.col("_bucket") == F.greatest(_bucket("time", "_level", width), _bucket(ws, "_level", width)))
        return match(left, right, [*by, "_level", "_bucket"]).where(test & once).drop("_level", "_bucket", "_own", "_w_own")
    left = things.withColumn("_level", F.explode(F.sequence(F.lit(0), top)))
    left = left.withColumn("_bucket", _bucket("time", "_level", width))
    if how == "contained":
        test = (F.col("time") >= F.col(ws)) & (F.col("endtime") <= F.col(we))
    elif how == "starting":
        test = F.col("time").between(F.col(ws), F.col(we))
    else:
        raise ValueError(f"unknown join {how!r}")
    return match(left, _spread(w, ws, we, width).drop("_own"), [*by, "_level", "_bucket"]).where(test).drop("_level", "_bucket")


def _held(things: DataFrame, containers: DataFrame, container: str, by: Sequence[str], width: int) -> DataFrame:
    """(_thing, _in): each thing with the last of the disjoint containers that starts at or before it, the only one that can hold it."""
    held = F.struct("time", "endtime", F.col(container).alias("id"))
    kind = containers.select(held.alias("h")).schema["h"].dataType
    lhs = things.select(*by, F.col("time").alias("_t"), F.lit(1).alias("_side"), F.struct(*things.columns).alias("_thing"), F.lit(None).cast(kind).alias("_held"))
    rhs = containers.select(*by, F.col("time").alias("_t"), F.lit(0).alias("_side"), F.lit(None).cast(lhs.schema["_thing"].dataType).alias("_thing"), held.alias("_held"))
    return ordered.fill_forward(lhs.unionByName(rhs), "_held", "_in", by, ("_t", "_side"), width).where("_side = 1")


def split_by_containment(things: DataFrame, containers: DataFrame, container: str, by: Sequence[str] = RUN, width: int = HOUR) -> DataFrame:
    """things that lie fully inside one of the disjoint containers, with that container's id. Disjoint containers need no copies."""
    if container in things.columns:
        raise ValueError(f"things have a column {container!r} already")
    inside = _held(things, containers, container, by, width).where(F.col("_thing.endtime") <= F.col("_in.endtime"))
    return inside.select("_thing.*", F.col("_in.id").alias(container))


def containing(things: DataFrame, containers: DataFrame, container: str, key: str, by: Sequence[str] = RUN, width: int = HOUR) -> DataFrame:
    """All things with the id of the disjoint container that holds them, null for none."""
    inside = F.col("_thing.endtime") <= F.col("_in.endtime")
    return _held(things, containers, container, by, width).select("_thing.*", F.when(inside, F.col("_in.id")).alias(container))


def outside(things: DataFrame, containers: DataFrame, key: str, by: Sequence[str] = RUN, width: int = HOUR, disjoint: bool = False) -> DataFrame:
    """things that lie in no container (lone hits, veto mask). Containers may overlap, unless they are said to be disjoint, which is cheaper."""
    if disjoint:
        held = _held(things, containers.withColumn("_c", F.lit(1)), "_c", by, width)
        return held.where(~F.coalesce(F.col("_thing.endtime") <= F.col("_in.endtime"), F.lit(False))).select("_thing.*")
    held = overlap_join(things.select(*by, "time", "endtime", key), containers.select(*by, "time", "endtime"), by, width, "contained")
    return match(things, held.select(*by, key).distinct(), [*by, key], "left_anti")


def overlap_duration(windows: DataFrame, spans: DataFrame, key: str, by: Sequence[str] = RUN, width: int = HOUR) -> DataFrame:
    """(by, key, overlap): nanoseconds of each window covered by spans, 0 for none."""
    met = overlap_join(windows.select(*by, "time", "endtime", key), spans.select(*by, "time", "endtime"), by, width)
    part = F.least("endtime", "w_endtime") - F.greatest("time", "w_time")
    sums = met.groupBy(*by, key).agg(F.sum(part).alias("overlap"))
    return match(windows.select(*by, key), sums, [*by, key], "left").select(*by, key, F.coalesce("overlap", F.lit(0).cast("long")).alias("overlap"))


def islands(df: DataFrame, reach: str, gap: int, by: Sequence[str] = RUN, order: Sequence[str] = ("time",), width: int = HOUR, inclusive: bool = True) -> DataFrame:
    """Adds ``island``, the start of its first row: a row opens a new one if it starts more than gap after the furthest reach of all rows before.

    inclusive: a start exactly gap after the reach still joins. Rows that open one as far as their own bucket goes are found first; what the
    buckets before reach decides which of them stand, and the last that stands is carried on. Both are one pass over the buckets' table.
    """
    if gap < (0 if inclusive else 1):
        raise ValueError("a smaller gap would let two islands start at one time")
    opens = lambda far: F.coalesce((far > gap) if inclusive else (far >= gap), F.lit(True))
    time = F.col(order[0])
    local = F.max(reach).over(within_part(order).rowsBetween(Window.unboundedPreceding, -1))
    rows = parted(df, by, width, order[0]).withColumn("_local", local).withColumn("_new", F.when(opens(time - F.col("_local")), time))
    sums = rows.groupBy("_part").agg(F.max(reach).alias("_reach"), F.max("_new").alias("_last"))
    sums = sums.withColumn("_before", F.max("_reach").over(before_part(by)))
    sums = sums.withColumn("_stands", F.when(opens(F.col("_last") - F.col("_before")), F.col("_last")))
    carry = sums.select("_part", "_before", F.last("_stands", ignorenulls=True).over(before_part(by)).alias("_open"))
    rows = rows.join(carry, "_part").withColumn("_new", F.when(opens(time - F.col("_before")), F.col("_new")))
    last = F.last("_new", ignorenulls=True).over(within_part(order).rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("island", F.coalesce(last, "_open")).drop("_part", "_local", "_new", "_before", "_open")


def numbered_islands(df: DataFrame, reach: str, gap: int, by: Sequence[str] = RUN, order: Sequence[str] = ("time",), width: int = HOUR, inclusive: bool = True) -> DataFrame:
    """The same with islands counted from 1 in each run."""
    marked = islands(df, reach, gap, by, order, width, inclusive)
    starts = marked.select(*by, "island").distinct()
    numbers = ordered.row_numbers(starts.withColumn("_start", F.col("island")), "_n", by, ("_start",), width).select(*by, "island", (F.col("_n") + 1).alias("_n"))
    return match(marked, numbers, [*by, "island"]).drop("island").withColumnRenamed("_n", "island")


def merge_intervals(df: DataFrame, by: Sequence[str] = RUN, width: int = HOUR) -> DataFrame:
    """Disjoint unions of touching or overlapping intervals; an end equal to the next start merges."""
    marked = islands(df.select(*by, "time", "endtime"), "endtime", 0, by, ("time", "endtime"), width)
    return marked.groupBy(*by, "island").agg(F.min("time").alias("time"), F.max("endtime").alias("endtime")).drop("island")


def coincidence(hits: DataFrame, n: int, resolving: int, pre: int = 0, by: Sequence[str] = RUN, key: str = "hit_id", width: int = HOUR) -> DataFrame:
    """Merged intervals [t - pre, t + resolving) of every hit that opens an n-fold coincidence: the n-th hit from it on comes
    less than ``resolving`` later. Hits just behind a bucket's end are copied into it, so no run is one task."""
    if width < resolving:
        raise ValueError("a bucket must be at least as wide as the resolving time")
    rows = with_bucket(hits.select(*by, "time", key), width)
    halo = F.when(F.expr(f"pmod(time, {width}L) < {resolving}"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = rows.withColumn("_off", F.explode(halo)).withColumn("_bucket", F.col("_bucket") - F.col("_off"))
    w = Window.partitionBy(*by, "_bucket").orderBy("time", key)
    near = rows.withColumn("_nth", F.lead("time", n - 1).over(w)).withColumn("_own", F.col("_off") == 0)
    opens = near.where("_own").where(F.col("_nth") - F.col("time") < resolving)
    spans = opens.select(*by, (F.col("time") - pre).alias("time"), (F.col("time") + resolving).alias("endtime"))
    return merge_intervals(spans, by, width)


def complement(df: DataFrame, start: int, end: int, by: Sequence[str] = RUN, width: int = HOUR) -> DataFrame:
    """The gaps between disjoint intervals and up to the run's start and end (empty gaps are kept out)."""
    rows = ordered.previous_row(df.select(*by, "time", "endtime"), ["endtime"], by, ("time", "endtime"), width)
    gaps = rows.select(*by, F.coalesce("prev_endtime", F.lit(start)).alias("a"), F.col("time").alias("b"))
    last = df.groupBy(*by).agg(F.max("endtime").alias("a")).select(*by, "a", F.lit(end).cast("long").alias("b"))
    return gaps.unionByName(last).where("a < b").withColumnsRenamed({"a": "time", "b": "endtime"})


def nearest(
    left: DataFrame, right: DataFrame, cols: Sequence[str], within: int | None = None, direction: str = "before", strict: bool = True,
    by: Sequence[str] = RUN, left_key: str = "hit_id", right_key: str = "hit_id", width: int = HOUR,
) -> DataFrame:
    """As-of join: for each left row the closest right row before (after) it, within ``within``; ties of time go to the
    largest (smallest) right key. Adds n_<col> and n_time, null for none."""
    after = direction == "after"
    packed = F.struct("time", F.col(right_key).alias("_rk"), *[F.col(c).alias(f"c_{c}") for c in cols])
    empty = right.select(packed.alias("p")).schema["p"].dataType
    # At equal times the right rows stand where they match (not strict) or where they do not (strict).
    order = int(after != strict)
    lhs = left.select(*by, "time", F.col(left_key).alias("_lk"), F.lit(1 - order).alias("_side"), F.lit(None).cast(empty).alias("_p"))
    rhs = right.select(*by, "time", F.lit(None).cast(left.schema[left_key].dataType).alias("_lk"), F.lit(order).alias("_side"), packed.alias("_p"))
    both = lhs.unionByName(rhs)
    fill = ordered.fill_backward if after else ordered.fill_forward
    both = both.withColumn("_tie", F.coalesce(F.col("_p")["_rk"], F.lit(0)))
    found = fill(both, "_p", "_near", by, ("time", "_side", "_tie"), width).where(F.col("_lk").isNotNull() & F.col("_p").isNull())
    gap = (F.col("_near")["time"] - F.col("time")) if after else (F.col("time") - F.col("_near")["time"])
    ok = F.lit(True) if within is None else gap <= within
    picked = found.select(*by, F.col("_lk").alias(left_key), F.when(ok, F.col("_near")).alias("_near"))
    joined = match(left, picked, [*by, left_key], "left")
    return joined.select(*left.columns, F.col("_near")["time"].alias("n_time"), *[F.col("_near")[f"c_{c}"].alias(f"n_{c}") for c in cols])


def nearest_triggers(left: DataFrame, triggers: DataFrame, cols: Sequence[str], within: int, by: Sequence[str] = RUN, key: str = "hit_id", width: int = HOUR) -> DataFrame:
    """(by, key, time, and left_<col>, left_dt, right_<col>, right_dt): fields of the closest trigger on each side within ``within``,
    of another time than one's own."""
    extra = triggers.select(*by, "time", F.col(key).alias("_id"), *[F.col(c).alias(f"f_{c}") for c in cols])
    fields = [f"f_{c}" for c in cols]
    lean = left.select(*by, "time", key)
    out = lean
    for side, direction in (("left", "before"), ("right", "after")):
        found = nearest(lean, extra, fields, within, direction, True, by, key, "_id", width)
        gap = F.abs(F.col("time") - F.col("n_time"))
        out = match(out, found.select(*by, key, *[F.col(f"n_{f}").alias(f"{side}_{c}") for f, c in zip(fields, cols)], gap.alias(f"{side}_dt")), [*by, key])
    return out


def nearest_absolute(left: DataFrame, right: DataFrame, cols: Sequence[str], by: Sequence[str] = RUN, key: str = "hit_id", width: int = HOUR) -> DataFrame:
    """(by, key, n_<col>, n_dt): the right row closest in time, of equally close ones the earlier."""
    extra = right.select(*by, "time", F.col(key).alias("_id"), *[F.col(c).alias(f"f_{c}") for c in cols])
    fields, lean = [f"f_{c}" for c in cols], left.select(*by, "time", key)
    one = nearest(lean, extra, fields, None, "before", False, by, key, "_id", width).withColumnsRenamed({f"n_{f}": f"l_{f}" for f in fields}).withColumn("dl", F.col("time") - F.col("n_time"))
    two = nearest(lean, extra, fields, None, "after", False, by, key, "_id", width).withColumn("dr", F.col("n_time") - F.col("time")).drop("time", "n_time")
    both = match(one, two, [*by, key])
    before = F.col("dr").isNull() | (F.col("dl") <= F.col("dr"))
    return both.select(*by, key, *[F.when(before, F.col(f"l_{f}")).otherwise(F.col(f"n_{f}")).alias(f"n_{c}") for f, c in zip(fields, cols)], F.when(before, F.col("dl")).otherwise(F.col("dr")).alias("n_dt"))


def distance_to_neighbours(left: DataFrame, spans: DataFrame, key: str, by: Sequence[str] = RUN, width: int = HOUR) -> DataFrame:
    """(by, key, to_previous, to_next): from a row's start to the last interval end before it, from its end to the next start
    after it; null where there is none or it overlaps."""
    ends = spans.select(*by, F.col("endtime").alias("time"), F.col("endtime").alias("_id"))
    starts = spans.select(*by, "time", F.col("time").alias("_id"))
    begin = left.select(*by, "time", key)
    finish = left.select(*by, F.col("endtime").alias("time"), key)
    prev = nearest(begin, ends, [], None, "before", True, by, key, "_id", width).select(*by, key, (F.col("time") - F.col("n_time")).alias("to_previous"))
    nxt = nearest(finish, starts, [], None, "after", True, by, key, "_id", width).select(*by, key, (F.col("n_time") - F.col("time")).alias("to_next"))
    return match(prev, nxt, [*by, key])


def pair_starts_stops(
    starts: DataFrame, stops: DataFrame, run_start: int, run_end: int, by: Sequence[str] = RUN, width: int = HOUR, name: str = "", artificial: DataFrame | None = None
) -> DataFrame:
    """(by, time, endtime, veto_type, veto_interval): the n-th start of a run with its n-th stop.

    A run whose last start comes after its last stop gets a stop at its end; if it then has one stop more than starts, a start at its
    beginning. Other unequal numbers, and a start after its stop, raise. artificial: intervals of dead time, passed through.
    """
    signals = starts.select(*by, "time", F.lit(1).alias("kind")).unionByName(stops.select(*by, "time", F.lit(0).alias("kind")))
    on, off = F.col("kind") == 1, F.col("kind") == 0
    ends = signals.groupBy(*by).agg(F.max(F.when(on, F.col("time"))).alias("a"), F.max(F.when(off, F.col("time"))).alias("b"), F.count_if(on).alias("n1"), F.count_if(off).alias("n0"))
    late = F.col("a").isNotNull() & (F.col("b").isNull() | (F.col("a") > F.col("b")))
    early = F.col("n0") + late.cast("long") - F.col("n1") == 1
    extra = lambda test, time, kind: ends.where(test).select(*by, F.lit(time).cast("long").alias("time"), F.lit(kind).alias("kind"))
    whole = signals.unionByName(extra(late, run_end, 0)).unionByName(extra(early, run_start, 1))
    numbered = ordered.row_numbers(whole, "n", (*by, "kind"), ("time",), width)
    sides = numbered.groupBy(*by, "n").agg(F.max(F.when(on, F.col("time"))).alias("a"), F.max(F.when(off, F.col("time"))).alias("b"))
    lost = F.raise_error(F.lit(f"unequal numbers of {name} starts and stops")).cast("long")
    wrong = F.raise_error(F.lit(f"a {name} veto starts after its stop")).cast("long")
    end = F.when(F.col("a").isNull() | F.col("b").isNull(), lost).when(F.col("a") > F.col("b"), wrong).otherwise(F.col("b"))
    out = sides.select(*by, F.col("a").alias("time"), end.alias("endtime"), F.lit(f"{name}veto").alias("veto_type"))
    if artificial is not None:
        out = out.unionByName(artificial.select(*by, "time", "endtime", F.lit("artificial_deadtime_veto").alias("veto_type")))
    return out.withColumn("veto_interval", F.col("endtime") - F.col("time"))


def check_overlaps(df: DataFrame, by: Sequence[str] = ("run_id", "channel"), width: int = HOUR) -> DataFrame:
    """Rows that start before the row before them in the same channel has ended."""
    rows = ordered.previous_row(df, ["endtime"], by, ("time", "endtime"), width)
    return rows.where(F.col("time") < F.col("prev_endtime"))


def isolated(df: DataFrame, gap: int, by: Sequence[str] = RUN, width: int = HOUR, key: str = "hit_id") -> DataFrame:
    """Rows whose neighbours on both sides are more than gap away; the run's ends count as far."""
    rows = ordered.neighbours(df, ["time"], ["time"], by, ("time", key), width)
    left = F.coalesce(F.col("time") - F.col("prev_time") > gap, F.lit(True))
    right = F.coalesce(F.col("next_time") - F.col("time") > gap, F.lit(True))
    return rows.where(left & right).select(*df.columns)
