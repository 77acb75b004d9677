"""Event building and per-event features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronofold.operators import ordered
from chronofold.operators.intervals import RUN, islands, split_by_containment
from chronofold.operators.ordered import HOUR, match
from chronofold.session import pinned


def build_events(
    peaks: DataFrame, triggers: DataFrame, left: int, right: int, start: int | None = None, end: int | None = None, veto_type: int | None = 3,
    by: Sequence[str] = RUN, key: str = "hit_id", width: int = HOUR,
) -> DataFrame:
    """Triggers closer than left + right form one event [first - left, last + right], clipped to the run; events that hold a peak of
    veto_type go; event_number counts in time order."""
    marked = islands(triggers.select(*by, "time", key), "time", left + right, by, ("time", key), max(width, left + right))
    spans = marked.groupBy(*by, "island").agg((F.min("time") - left).alias("time"), (F.max("time") + right).alias("endtime"))
    if start is not None:
        spans = spans.withColumn("time", F.greatest("time", F.lit(start)))
    if end is not None:
        spans = spans.withColumn("endtime", F.least("endtime", F.lit(end)))
    if veto_type is not None:
        inside = split_by_containment(peaks.where(F.col("type") == veto_type).select(*by, "time", "endtime"), spans, "island", by, width)
        spans = match(spans, inside.select(*by, "island").distinct(), [*by, "island"], "left_anti")
    return pinned(ordered.row_numbers(pinned(spans.drop("island")), "event_number", by, ("time",), max(width, left + right)))


def event_basics(
    peaks: DataFrame, events: DataFrame, drift_max: int, s1_min_coincidence: int = 2, s1_before_s2: bool = True, alt_in_drift: bool = True,
    main_before_alt: bool = False, coincidence: str = "tight_coincidence", props: Sequence[str] = ("area", "center_time"),
    key: str = "hit_id", by: Sequence[str] = RUN, width: int = HOUR,
) -> DataFrame:
    """One row per event: its main and alternate S1 and S2, drift times, and the largest S2 before and after the main one.

    Main is the largest by area, of equal ones the later. S1s must start before the main S2 (unless s1_before_s2 is off) and have the least
    coincidence; the alternate S2 must come within 1.01 * drift_max after the main S1 (alt_in_drift).
    Every choice is a max over structs in a window over the event, so the peaks are dealt by event once and the window
    spills instead of collecting an event.
    """
    event = [*by, "event_number"]
    inside = split_by_containment(peaks, events, "event_number", by, width)
    fields = list(dict.fromkeys([key, "time", *props]))
    rank = F.struct(F.col("area"), F.col("time"), F.col(key), *[F.col(c) for c in fields if c not in ("area", "time", key)])
    whole = Window.partitionBy(*event)

    def best(test: Column) -> Column:
        return F.max(F.when(test, rank)).over(whole)

    rows = inside.withColumn("m2", best(F.col("type") == 2))
    ok1 = (F.col("type") == 1) & (F.col(coincidence) >= s1_min_coincidence)
    if s1_before_s2:
        ok1 = ok1 & (F.col("m2").isNull() | (F.col("time") < F.col("m2.time")))
    rows = rows.withColumn("m1", best(ok1)).withColumn("a1", best(ok1 & (F.col(key) != F.col("m1")[key])))
    ok2 = (F.col("type") == 2) & (F.col(key) != F.col("m2")[key])
    if alt_in_drift:
        late = F.col("center_time") - F.col("m1.center_time")
        ok2 = ok2 & (F.col("m1").isNull() | ((late > 0) & (late < 1.01 * drift_max)))
    side = F.when((F.col("type") == 2) & F.col("m2").isNotNull(), F.signum(F.col("center_time") - F.col("m2.center_time")))
    large = F.struct("area", (-F.col("time")).alias("t"), F.col("center_time").alias("c"))
    found = rows.groupBy(*event).agg(
        F.count(F.lit(1)).alias("n_peaks"), *[F.first(c).alias(c) for c in ("m2", "m1", "a1")], F.max(F.when(ok2, rank)).alias("a2"),
        F.coalesce(F.sum(F.when(side < 0, F.col("area"))), F.lit(0)).alias("area_before_main_s2"),
        F.max(F.when(side > 0, large)).alias("after"), F.max(F.when(side < 0, large)).alias("before"),
    )
    out = match(events.select(*event, "time", "endtime"), found, event, "left")
    m2, a2 = F.col("m2"), F.col("a2")
    if main_before_alt:
        swap = F.col("a2").isNotNull() & (F.col("a2.time") < F.col("m2.time"))
        m2, a2 = F.when(swap, F.col("a2")).otherwise(F.col("m2")), F.when(swap, F.col("m2")).otherwise(F.col("a2"))
    m1, a1 = F.col("m1"), F.col("a1")
    both = F.when(m1.isNotNull() & m2.isNotNull(), True)
    roles = {"s1": m1, "alt_s1": a1, "s2": m2, "alt_s2": a2}
    cols = [role[c].alias(f"{name}_{c}") for name, role in roles.items() for c in fields]
    drift = lambda x, y: F.when(both, x["center_time"] - y["center_time"])
    return out.select(
        *event, "time", "endtime", F.coalesce("n_peaks", F.lit(0).cast("long")).alias("n_peaks"), *cols,
        drift(m2, m1).alias("drift_time"), drift(m2, a1).alias("alt_s1_interaction_drift_time"), drift(a1, m1).alias("alt_s1_delay"),
        drift(a2, m1).alias("alt_s2_interaction_drift_time"), drift(a2, m2).alias("alt_s2_delay"),
        F.coalesce("area_before_main_s2", F.lit(0).cast("long")).alias("area_before_main_s2"),
        F.col("before.area").alias("large_s2_before_main_s2_area"), F.col("before.c").alias("large_s2_before_main_s2_center_time"),
        F.col("after.area").alias("large_s2_after_main_s2_area"), F.col("after.c").alias("large_s2_after_main_s2_center_time"),
    )


def attach_by_role(
    events: DataFrame, values: DataFrame, cols: Sequence[str], key: str = "hit_id", roles: Sequence[str] = ("s1", "s2", "alt_s1", "alt_s2"), by: Sequence[str] = RUN
) -> DataFrame:
    """Joins per-peak values to each role's peak: <role>_<col>, null where the role is empty."""
    out = events
    for role in roles:
        side = values.select(*by, F.col(key).alias(f"{role}_{key}"), *[F.col(c).alias(f"{role}_{c}") for c in cols])
        out = match(out, side, [*by, f"{role}_{key}"], "left")
    return out


def as_double_scatter(events: DataFrame) -> DataFrame:
    """Renames the four roles to the two S1s and S2s of a double scatter: s1_a, s1_b, s2_a, s2_b."""
    swap = (("alt_s1_", "s1_b_"), ("alt_s2_", "s2_b_"), ("s1_", "s1_a_"), ("s2_", "s2_a_"))
    names = {}
    for c in events.columns:
        for old, new in swap:
            if c.startswith(old) and not c.endswith(("interaction_drift_time", "delay")):
                names[c] = new + c[len(old) :]
                break
    return events.withColumnsRenamed(names)


def event_number_of(peaks: DataFrame, events: DataFrame, key: str = "hit_id", by: Sequence[str] = RUN, width: int = HOUR) -> DataFrame:
    """(by, key, event_number, drift_time): the event that holds each peak (-1 for none) and, for S2s, the time since the main S1."""
    inside = split_by_containment(peaks.select(*by, "time", "endtime", key, "type", "center_time"), events, "event_number", by, width)
    with_s1 = match(inside, events.select(*by, "event_number", "s1_center_time"), [*by, "event_number"])
    found = with_s1.select(*by, key, "event_number", F.when(F.col("type") == 2, F.col("center_time") - F.col("s1_center_time")).alias("drift_time"))
    return match(peaks.select(*by, key), found, [*by, key], "left").withColumn("event_number", F.coalesce("event_number", F.lit(-1).cast("long")))


def multi_scatter(peaks: DataFrame, container: str, weight: str, values: Sequence[str], selected: Column, by: Sequence[str] = RUN) -> DataFrame:
    """Per container: number of selected peaks, their summed weight and weighted means of values (nulls ignored)."""
    w = F.when(selected, F.col(weight))
    means = [F.try_divide(F.sum(w * F.col(v)), F.sum(F.when(F.col(v).isNotNull(), w))).alias(f"{v}_avg") for v in values]
    return peaks.groupBy(*by, container).agg(F.count_if(selected).alias("multiplicity"), F.sum(w).alias(f"{weight}_sum"), *means)


def distinct_channels(rows: DataFrame, container: str, channel: str, alt: Column, main: Column, by: Sequence[str] = RUN) -> DataFrame:
    """Per container: channels that the alternate signal has and the main one lacks."""
    sides = rows.groupBy(*by, container, channel).agg(F.bool_or(alt).alias("in_alt"), F.bool_or(main).alias("in_main"))
    return sides.groupBy(*by, container).agg(F.count_if(F.col("in_alt") & ~F.col("in_main")).alias("n_distinct_channels"))


def largest(df: DataFrame, n: int, by: str = "area", time: str = "time", key: str = "hit_id") -> DataFrame:
    """The n largest rows, of equal ones the earlier, in time order."""
    return df.orderBy(F.col(by).desc(), F.col(time), F.col(key)).limit(n).orderBy(time, key)


def ranked(df: DataFrame, n: int, within: Sequence[str], key: str = "hit_id") -> DataFrame:
    """The n largest rows of each group, of equal ones the later."""
    w = Window.partitionBy(*within).orderBy(F.col("area").desc(), F.col("time").desc(), F.col(key).desc())
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
