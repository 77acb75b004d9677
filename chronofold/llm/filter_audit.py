"""Filter interaction audit: what each filter removes in every order, from additive counters of failure masks.

1. Duplicates are found by sorting: rows are dealt by range of (text fingerprint, id), so a text with very many copies is spread over many
   ranges, and each range is sorted by fingerprint, full text and id. A row repeats if its predecessors in its run of equal texts
   have a smaller id. A run that touches the edge of its range may go on in others: each range reports the first id and full
   text of such runs (two a range, more only if fingerprints collide), equal texts meet, and their least id goes back to the runs.
2. Each row's failures are the bits of a mask. Rows add up to counters per (part, mask, good, toxic), at most 128 a part.
3. Whatever an order removes at a step depends only on the filter and on the set of filters before it: 80 such pairs a part are summed
   from the counters, and the 120 orders look them up. A filter's Shapley sum weighs its pairs by the number of orders that have them.

Defined cases: null texts are empty; null sources are the part ""; a null id is neither smaller than another nor has smaller ones; rows with
one id and one text do not repeat each other; a row without label is neither good nor toxic, of several labels of an id the highest
counts; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronofold.llm.common import ASCII_SPACE, UPPER, materialize, text_or_empty

FILTERS = "ABCDE"


def failures(text: Column) -> Column:
    """Bits of the filters A to D that a text fails."""
    bare = F.btrim(text, F.lit(ASCII_SPACE))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, "[ \\t-\\r]+"))
    n, kinds = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.translate(text, UPPER, ""))
    tests = (n < 200, 100 * kinds < 50 * n, 100 * capitals > 2 * F.length(text), text.rlike("[#$%&*|]"))
    return sum(((t.cast("int") * (1 << i)) for i, t in enumerate(tests)), F.lit(0))


#: kind 0: a row. kind 1: a run of equal texts at the edge of its range, with its text; runs are numbered within the range.
_SCANNED = "kind int, range int, run long, id {id}, part string, mask int, print long, first {id}, text string"


def _scan(id_type: pa.DataType):
    """mapInArrow over one range sorted by (print, text, id): rows with the number of their run and its first id, then runs at the edges."""

    def run(batches):
        from pyspark import TaskContext

        where = TaskContext.get().partitionId()
        number, last_text, last_print, first, lowest = -1, None, None, None, None
        edge: list[tuple] = []

        def out(n, kind, runs, ids, parts, masks, prints, firsts, texts):
            cols = [pa.array([kind] * n, pa.int32()), pa.array([where] * n, pa.int32()), pa.array(runs, pa.int64()), ids, parts, masks, prints, firsts, texts]
            return pa.RecordBatch.from_arrays(cols, names=["kind", "range", "run", "id", "part", "mask", "print", "first", "text"])

        def edges(found):
            n = len(found)
            return out(n, 1, [f[0] for f in found], pa.nulls(n, id_type), pa.nulls(n, pa.string()), pa.nulls(n, pa.int32()), pa.array([f[1] for f in found], pa.int64()),
                       pa.array([f[2] for f in found], id_type), pa.array([f[3] for f in found], pa.string()))

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            prints, texts, ids = batch.column("print"), batch.column("text"), batch.column("id")
            heads = [i + 1 for i, same in enumerate(pc.and_(pc.equal(prints[1:], prints[:-1]), pc.equal(texts[1:], texts[:-1])).to_pylist()) if not same] if n > 1 else []
            if prints[0].as_py() != last_print or texts[0].as_py() != last_text:
                heads.insert(0, 0)
            runs, firsts, at = [], [], 0
            for head in [*heads, n]:
                runs.extend([number] * (head - at))
                firsts.extend([first] * (head - at))
                if head < n:
                    own = prints[head].as_py()
                    if own != last_print:
                        # The runs of the fingerprint before are at the edge only if it opened the range.
                        if lowest is not None and last_print == lowest and edge:
                            yield edges(edge)
                        edge, last_print = [], own
                        lowest = own if lowest is None else lowest
                    number, first, last_text = number + 1, ids[head].as_py(), texts[head].as_py()
                    edge.append((number, own, first, last_text))
                at = head
            yield out(n, 0, runs, ids, batch.column("part"), batch.column("mask"), prints, pa.array(firsts, id_type), pa.nulls(n, pa.string()))
        if edge:
            yield edges(edge)

    return run


def masks(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source", with_texts: bool = True) -> DataFrame:
    """(id, part, mask) of every row: the bits of all five filters."""
    from pyspark.sql.pandas.types import to_arrow_type

    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), text_or_empty(text).alias("text"))
    rows = rows.withColumn("print", F.xxhash64("text"))
    # Null ids come last, so that a run's first id is one that can be smaller.
    dealt = rows.repartitionByRange("print", F.col("id").asc_nulls_last()).sortWithinPartitions("print", "text", F.col("id").asc_nulls_last())
    dealt = dealt.select("id", "part", failures(F.col("text")).alias("mask"), "print", "text")
    kind = rows.schema["id"].dataType
    scanned = materialize(dealt.mapInArrow(_scan(to_arrow_type(kind)), _SCANNED.format(id=kind.simpleString())), "scanned")
    edge = scanned.where("kind = 1")
    edge = edge.select("range", "run", F.min("first").over(Window.partitionBy("print", "text")).alias("least"))
    own = scanned.where("kind = 0").select("range", "run", "id", "part", "mask", "first").join(F.broadcast(edge), ["range", "run"], "left")
    again = F.coalesce(F.coalesce("least", "first") < F.col("id"), F.lit(False))
    return own.select("id", "part", F.col("mask").bitwiseOR(again.cast("int") * 16).alias("mask"))


def counters(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(part, mask, n, good, toxic): additive over any split of the documents by part."""
    marks = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("g"), F.max((F.col("toxic") == 1).cast("int")).alias("t"))
    rows = masks(docs, key, text, part).join(marks, "id", "left")
    one = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return rows.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), one("g").alias("good"), one("t").alias("toxic"))


def _orders(spark) -> DataFrame:
    rows = []
    for order in permutations(FILTERS):
        for step, name in enumerate(order):
            rows.append(("".join(order), step + 1, FILTERS.index(name), sum(1 << FILTERS.index(f) for f in order[:step])))
    return spark.createDataFrame(rows, "filter_order string, step int, filter int, earlier int")


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley): zeros included."""
    spark, count = docs.sparkSession, len(FILTERS)
    pairs = [(f, s, factorial(bin(s).count("1")) * factorial(count - 1 - bin(s).count("1"))) for f in range(count) for s in range(1 << count) if not s >> f & 1]
    every = F.array(*[F.struct(F.lit(f).alias("filter"), F.lit(s).alias("earlier"), F.lit(w).alias("weight")) for f, s, w in pairs])
    found = counters(docs, labels, key, text, part).withColumn("p", F.explode(every)).select("*", "p.*")
    bit = F.expr("shiftleft(1, filter)")
    fails, gone = F.col("mask").bitwiseAND(bit) != 0, F.col("mask").bitwiseAND(F.col("earlier")) != 0
    total = lambda test, value: F.sum(F.when(test, F.col(value)).otherwise(0))
    steps = found.groupBy("part", "filter", "earlier", "weight").agg(
        total(~fails & ~gone, "n").alias("kept"), total(fails & ~gone, "n").alias("removed"), total(fails & gone, "n").alias("redundant"), total(F.col("mask") == bit, "n").alias("unique_fails"),
        total(fails & ~gone, "good").alias("good_lost"), total(fails & ~gone, "toxic").alias("toxic_lost"),
    )
    steps = steps.withColumn("shapley", F.sum(F.col("removed") * F.col("weight")).over(Window.partitionBy("part", "filter")))
    out = steps.join(F.broadcast(_orders(spark)), ["filter", "earlier"])
    return out.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
