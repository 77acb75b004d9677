"""Ordered (window) computations over time that do not put a run into one task.

A window partitioned by run alone is a single task. Here rows are windowed per (run, time bucket), and what
crosses a bucket's edge is carried by a table with one row per bucket: aggregates are computed inside each bucket, their
running value over earlier buckets is a window over that small table, and a join on the bucket brings it back.

Null keys are keys like any other: rows without a run (or channel) form a run of their own, as groupBy has it. Partitions and joins
go by one struct of keys and bucket, in which nulls are equal.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Default bucket: one hour in nanoseconds.
HOUR = 3600 * 10**9


def with_bucket(df: DataFrame, width: int, time: str = "time", name: str = "_bucket") -> DataFrame:
    """Adds the bucket number, rounding down for negative times too."""
    return df.withColumn(name, F.expr(f"({time} - pmod({time}, {width}L)) div {width}L"))


def match(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on columns of both sides in which nulls are equal."""
    keys = F.struct(*[F.col(c) for c in on]).alias("_on")
    return left.withColumn("_on", keys).join(right.select(keys, *[c for c in right.columns if c not in on]), "_on", how).drop("_on")


def parted(df: DataFrame, by: Sequence[str], width: int, time: str = "time") -> DataFrame:
    """Adds ``_part``: the keys and the number of the time bucket."""
    return with_bucket(df, width, time).withColumn("_part", F.struct(*[F.col(c) for c in by], F.col("_bucket"))).drop("_bucket")


def within_part(order: Sequence[str | Column]):
    return Window.partitionBy("_part").orderBy(*order)


def before_part(by: Sequence[str], backwards: bool = False):
    """All earlier (later) buckets of a run, over a table with one row per bucket."""
    side = F.col("_part._bucket").desc() if backwards else F.col("_part._bucket").asc()
    return Window.partitionBy(*[F.col(f"_part.{c}") for c in by]).orderBy(side).rowsBetween(Window.unboundedPreceding, -1)


def carried(
    df: DataFrame,
    per_bucket: dict[str, Column],
    running: dict[str, Callable[[Column], Column]],
    by: Sequence[str],
    backwards: bool | Sequence[str] = False,
) -> DataFrame:
    """df (with _part) plus, for each name, the running aggregate over all earlier buckets (later ones for the names in
    ``backwards``, or for all).

    per_bucket: aggregate of one bucket; running: how bucket values combine (an aggregate function). All names share one pass.
    """
    later = set(per_bucket) if backwards is True else set(backwards or ())
    sums = df.groupBy("_part").agg(*[c.alias(f"_v_{n}") for n, c in per_bucket.items()])
    carry = sums.select("_part", *[running[n](F.col(f"_v_{n}")).over(before_part(by, n in later)).alias(n) for n in per_bucket])
    return df.join(carry, "_part")


def running_max_before(df: DataFrame, value: str, out: str, by: Sequence[str], order: Sequence[str], width: int = HOUR) -> DataFrame:
    """out: the largest value among all earlier rows (null for the first)."""
    rows = parted(df, by, width, order[0])
    rows = carried(rows, {"_carry": F.max(value)}, {"_carry": F.max}, by)
    local = F.max(value).over(within_part(order).rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn(out, F.greatest(local, "_carry")).drop("_carry", "_part")


def running_sum(df: DataFrame, value: str, out: str, by: Sequence[str], order: Sequence[str], width: int = HOUR) -> DataFrame:
    """out: sum of value over this and all earlier rows."""
    rows = parted(df, by, width, order[0])
    rows = carried(rows, {"_carry": F.sum(value)}, {"_carry": F.sum}, by)
    local = F.sum(value).over(within_part(order).rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn(out, local + F.coalesce("_carry", F.lit(0))).drop("_carry", "_part")


def previous_row(df: DataFrame, cols: Sequence[str], by: Sequence[str], order: Sequence[str], width: int = HOUR, prefix: str = "prev_") -> DataFrame:
    """Columns of the row before in order, null for the first."""
    return _neighbour(df, cols, by, order, width, prefix, False)


def next_row(df: DataFrame, cols: Sequence[str], by: Sequence[str], order: Sequence[str], width: int = HOUR, prefix: str = "next_") -> DataFrame:
    """Columns of the row after in order, null for the last."""
    return _neighbour(df, cols, by, order, width, prefix, True)


def _neighbour(df, cols, by, order, width, prefix, after):
    return neighbours(df, (), cols, by, order, width, "prev_", prefix) if after else neighbours(df, cols, (), by, order, width, prefix)


def neighbours(
    df: DataFrame, previous: Sequence[str], following: Sequence[str], by: Sequence[str], order: Sequence[str], width: int = HOUR,
    prefix: str = "prev_", next_prefix: str = "next_", reach: str | None = None,
) -> DataFrame:
    """Columns of the row before and of the row after in order, in one pass; with reach also the largest value of that column
    among all earlier rows, as ``reach``. Null where there is no such row."""
    rows = parted(df, by, width, order[0])
    packed = lambda cols: F.struct(*[F.col(c) for c in (*order, *[c for c in cols if c not in order])])
    edges, running, later = {}, {}, []
    if previous:
        edges["_before"], running["_before"] = F.max(packed(previous)), F.max
    if following:
        edges["_after"], running["_after"] = F.min(packed(following)), F.min
        later = ["_after"]
    if reach:
        edges["_reach"], running["_reach"] = F.max(reach), F.max
    rows = carried(rows, edges, running, by, later)
    local = within_part(order)
    if previous:
        rows = rows.withColumn("_before", F.coalesce(F.lag(packed(previous), 1).over(local), F.col("_before")))
    if following:
        rows = rows.withColumn("_after", F.coalesce(F.lead(packed(following), 1).over(local), F.col("_after")))
    if reach:
        rows = rows.withColumn("_reach", F.greatest(F.max(reach).over(local.rowsBetween(Window.unboundedPreceding, -1)), "_reach"))
    return rows.select(
        *df.columns, *[F.col("_before")[c].alias(f"{prefix}{c}") for c in previous], *[F.col("_after")[c].alias(f"{next_prefix}{c}") for c in following],
        *([F.col("_reach").alias("reach")] if reach else []),
    )


def fill_forward(df: DataFrame, value: str, out: str, by: Sequence[str], order: Sequence[str], width: int = HOUR) -> DataFrame:
    """out: the last non-null value at or before each row."""
    return _fill(df, value, out, by, order, width, False)


def fill_backward(df: DataFrame, value: str, out: str, by: Sequence[str], order: Sequence[str], width: int = HOUR) -> DataFrame:
    """out: the first non-null value at or after each row."""
    return _fill(df, value, out, by, order, width, True)


def _fill(df, value, out, by, order, width, after):
    rows = parted(df, by, width, order[0])
    dated = F.when(F.col(value).isNotNull(), F.struct(*[F.col(c) for c in order], F.col(value).alias("_value")))
    rows = carried(rows, {"_carry": (F.min if after else F.max)(dated)}, {"_carry": F.min if after else F.max}, by, backwards=after)
    # Backwards in reverse order: a frame that grows costs a row once, one that shrinks costs its whole rest for each row.
    span = within_part([F.col(c).desc() if after else F.col(c).asc() for c in order])
    local = F.last(dated, ignorenulls=True).over(span.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn(out, F.coalesce(local, F.col("_carry"))["_value"]).drop("_carry", "_part")


def row_numbers(df: DataFrame, out: str, by: Sequence[str], order: Sequence[str], width: int = HOUR) -> DataFrame:
    """out: 0-based place of each row in its run."""
    counted = running_sum(df.withColumn("_one", F.lit(1).cast("long")), "_one", out, by, order, width)
    return counted.withColumn(out, F.col(out) - 1).drop("_one")
