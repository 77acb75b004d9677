"""Mixing sources to target weights, cut at each source's exact budget.

1. Every row gets a size (its words) and a hash-random key, the digest of seed, id and text, which every rerun repeats.
2. Sources share the budget by weight, but none takes more than ``epochs`` times its size; what it leaves is shared again by the
   weights of the others. That is the level at which the sum of least(limit, level * weight) is the budget, found by running
   sums over the sources in order of limit / weight.
3. Rows are sorted by range within their source: the leading bits of the key, which is uniform, name one of many equal ranges, so no
   sample is needed and no source is one task. Sums per range and their running sums give each range its start; running sums in
   the range give each row its own.
4. A source's budget in whole words is spent on whole epochs first; the rest is taken from the front of the order, and the document
   where it ends gives its first words only. So each source takes its budget exactly.

The table of sources (one row each) is ordered in one task: a mix is written down by source, so it has as many rows as a configuration.
Rows are never collected, and ranges grow in number with the rows.

Defined cases: null texts have size zero; a null source is a source of its own, after all others; repeated rows tie and share one place in
the order one after the other; null ids are hashed as empty; an empty table, or one without words, takes nothing; other columns are carried.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronofold.llm.common import ASCII_SPACE, materialize, text_or_empty

#: Rows that one range should hold on average.
RANGE_ROWS = 50_000


def word_count(text: Column) -> Column:
    """Number of words between ASCII white space."""
    bare = F.btrim(text, F.lit(ASCII_SPACE))
    return F.when(bare == "", 0).otherwise(F.size(F.split(bare, "[ \\t-\\r]+"))).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int], epochs: int = 3) -> DataFrame:
    """(source, source_size, target) from (source, source_size): all words of all sources shared by weights, dealt in turn to the sources
    in the order of their code points, null last."""
    named = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(named) - 1) % len(weights)
    rows = sizes.withColumn("w", F.element_at(F.array(*[F.lit(int(w)).cast("long") for w in weights]), turn + 1)).withColumn("most", epochs * F.col("source_size"))
    # By the least limit in proportion to the weight: while the level of all that are left is above it, the source stops at its limit.
    order = Window.orderBy(F.col("most").cast("double") / F.col("w"), F.col("source").asc_nulls_last())
    before, whole = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    rows = rows.select(
        "source", "source_size", "w", "most", F.sum("source_size").over(whole).alias("total"), F.sum("w").over(whole).alias("all_w"),
        F.coalesce(F.sum("most").over(before), F.lit(0)).alias("spent"), F.coalesce(F.sum("w").over(before), F.lit(0)).alias("used_w"),
    )
    left, left_w = F.col("total") - F.col("spent"), F.col("all_w") - F.col("used_w")
    free = left * F.col("w") <= F.col("most") * left_w
    rows = rows.withColumns({"left": left, "left_w": left_w}).withColumn("level", F.when(free, F.struct("used_w", "left", "left_w")))
    rows = rows.withColumn("level", F.min("level").over(whole))
    share = (F.col("level.left") * F.col("w")).cast("double") / F.col("level.left_w")
    stopped = F.col("level").isNull() | (F.col("used_w") < F.col("level.used_w"))
    return rows.select("source", "source_size", F.when(stopped, F.col("most").cast("double")).otherwise(share).alias("target"))


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), epochs: int = 3, seed: int = 0, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """docs without its text: (key, source, size, source_size, target, taken, digest) per row; digest names the row's text for mixture()."""
    digest = F.md5(text_or_empty(text).cast("binary"))
    mark = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(key).cast("string"), F.lit("")), digest).cast("binary"))
    rows = docs.select(F.col(key).alias("key"), F.col(source).alias("source"), word_count(text_or_empty(text)).alias("size"), digest.alias("digest"), mark.alias("mark"))
    rows = materialize(rows, "sizes")
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    shares = materialize(targets(sums, weights, epochs), "targets")

    ranges = max(rows.count() // RANGE_ROWS + 1, 64)
    place = (F.conv(F.substring("mark", 1, 8), 16, 10).cast("double") * ranges / (1 << 32)).cast("int")
    rows = rows.withColumn("range", place)
    starts = rows.groupBy("source", "range").agg(F.sum("size").alias("n"))
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select(F.col("source").alias("s"), F.col("range").alias("r"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    starts = starts.join(shares, F.col("s").eqNullSafe(F.col("source"))).drop("source")
    placed = rows.join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r")))
    inside = Window.partitionBy("source", "range").orderBy("mark", "digest").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("start") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    budget = F.floor("target")
    times = F.when(F.col("source_size") > 0, F.call_function("div", budget, F.col("source_size"))).otherwise(0)
    rest = budget - F.col("times") * F.col("source_size")
    placed = placed.withColumns({"before": before, "times": times}).withColumn("rest", rest)
    taken = F.col("times") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before")))
    return placed.select(F.col("key").alias(key), F.col("source").alias(source), "size", "source_size", "target", taken.cast("long").alias("taken"), "digest")


def mixture(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), epochs: int = 3, seed: int = 0, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: docs' columns, once for each epoch that takes the row, with ``epoch`` (from 0); the row where a budget ends has its
    first words only, joined by single spaces. Rows that give no words are absent."""
    plan = mix(docs, weights, epochs, seed, key, text, source).where("taken > 0").groupBy(F.col(key).alias("_k"), F.col(source).alias("_s"), F.col("digest").alias("_d"))
    # Repeated rows tie, so any of them may be the one that is cut.
    plan = plan.agg(F.sort_array(F.collect_list(F.struct("taken", "size")), asc=False).alias("_plan"))
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col(key).alias("_k"), F.col(source).alias("_s"), F.md5(text_or_empty(text).cast("binary")).alias("_d"))
    same = Window.partitionBy("_k", "_s", "_d").orderBy(F.monotonically_increasing_id())
    rows = rows.withColumn("_n", F.row_number().over(same))
    left = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("_k", "_s", "_d")]
    met = rows.alias("a").join(plan.alias("b"), left[0] & left[1] & left[2]).where(F.col("_n") <= F.size("_plan"))
    met = met.select("_row", F.element_at("_plan", F.col("_n")).alias("_p"))
    met = met.select("_row", "_p", F.posexplode(F.sequence(F.lit(0), F.ceil(F.col("_p.taken") / F.col("_p.size")).cast("int") - 1)).alias("epoch", "_e"))
    words = F.least(F.col("_p.size"), F.col("_p.taken") - F.col("epoch") * F.col("_p.size"))
    bare = F.btrim(F.col(f"_row.{text}"), F.lit(ASCII_SPACE))
    front = F.array_join(F.slice(F.split(bare, "[ \\t-\\r]+"), F.lit(1), words.cast("int")), " ")
    cut = F.when(words < F.col("_p.size"), front).otherwise(F.col(f"_row.{text}"))
    return met.select(*[(cut if c == text else F.col(f"_row.{c}")).alias(c) for c in docs.columns], "epoch")
