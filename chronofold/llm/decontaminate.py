"""Benchmark decontamination over a distributed positional inverted index, in DataFrame functions only.

1. ``store_rows`` writes the training rows once, each under a number of its own; ``build_index`` splits their texts, once, and writes the
   postings (term, row, place) of every token where they are read, as sorted segments: no posting is shuffled.
2. Benchmark texts become distinct numbered windows of ten words (shorter items: one window).
3. ``term_counts`` reads from the index how often each test term occurs.
4. ``phrase_matches`` takes the postings of a window's rarest term, subtracts its offset to get a start, intersects with the
   offset-adjusted postings of the next rarest, and then with those of all other terms: a start at which every term of the window stands in
   its place is an exact match.
5. ``contamination`` sums the words that matches cover and lists their items, per row.
``near_matches`` answers from the same index which rows hold, within a span, the two rarest terms of a window among those that occur at all:
a window with a word that no document has can be near one, though it is nowhere as a phrase.

Tables made from the benchmark, and the rows that have candidates, are broadcast only if their measured size is within BROADCAST_BYTES; beyond
it the same joins shuffle.

Defined cases: null and empty texts have no words, windows or hits; items without words match nothing;
repeated rows, equal ids and null ids are judged row by row; windows with equal words belong to
every item that has them; empty tables give no hits; other columns are ignored, or carried if they are named in ``extra``, whatever
their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofold.llm.common import LOWER, UPPER, drop, materialize, opaque, text_or_empty

WINDOW = 10
BROADCAST_BYTES = 16 << 20
#: Separators before lower-casing: everything of ASCII but digits and letters.
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"


def _lower(word: Column) -> Column:
    """A-Z lower-cased; words of ASCII alone take the fast function."""
    return F.when(F.octet_length(word) == F.length(word), F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))


def words_of(text: Column) -> Column:
    return F.filter(F.split(_lower(text), SEPARATORS), lambda w: w != "")


def bounded(table: DataFrame) -> DataFrame:
    """Broadcast a stored table whose measured size is within the bound."""
    width = F.lit(32)
    for f in table.schema.fields:
        width = width + (F.coalesce(F.octet_length(f.name), F.lit(0)) if f.dataType.simpleString() == "string" else F.lit(16))
    size = table.agg(F.sum(width.cast("long"))).first()[0] or 0
    return F.broadcast(table) if size <= BROADCAST_BYTES else table


def benchmark_windows(items: DataFrame, size: int = WINDOW, item: str = "item_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Two stored tables: (win, off, term, n), the terms of each distinct window of n words, and (win, item), the items (as
    strings) that have it."""
    words = items.select(F.col(item).cast("string").alias("item"), opaque(words_of(text_or_empty(text))).alias("words"))
    n = F.size("words")
    starts = F.sequence(F.lit(1), F.greatest(n - (size - 1), F.lit(1)))
    found = words.where(n > 0).select("item", F.explode(F.transform(starts, lambda i: F.slice("words", i, size))).alias("words")).distinct()
    numbered = materialize(found.select("words").distinct().select(F.monotonically_increasing_id().alias("win"), "words"), "windows")
    owners = materialize(found.join(numbered, "words").select("win", "item"), "window-items")
    terms = numbered.select("win", F.size("words").alias("n"), F.posexplode("words").alias("off", "term"))
    return materialize(terms.select("win", "off", "term", "n"), "window-terms"), owners


def store_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", extra: tuple = ()) -> DataFrame:
    """(row, key, text, extra) of every row, stored; row is a number that no other row has, key a struct of the key alone."""
    carried = F.struct(F.col(key).alias("key"), *[F.col(c).alias(f"x{i}") for i, c in enumerate(extra)])
    return materialize(docs.select(F.monotonically_increasing_id().alias("row"), carried.alias("carried"), text_or_empty(text).alias("text")), "rows")


def build_index(rows: DataFrame) -> DataFrame:
    """The stored postings (term, row, place) of every token; place counts from 0."""
    # A leading separator leaves one empty string in front, a trailing one behind; neither is a word.
    cut = rows.select("row", opaque(F.split("text", SEPARATORS)).alias("words"))
    spread = cut.select("row", F.posexplode("words").alias("at", "word"), F.when(F.get("words", F.lit(0)) == "", 1).otherwise(0).alias("lead"))
    postings = spread.where("word <> ''").select(_lower(F.col("word")).alias("term"), "row", (F.col("at") - F.col("lead")).alias("place"))
    return materialize(postings.sortWithinPartitions("term"), "postings")


def term_counts(index: DataFrame, windows: DataFrame) -> DataFrame:
    """(term, n): occurrences over all documents of each term of the windows that has any; stored."""
    terms = materialize(windows.select("term").distinct(), "test-terms")
    seen = index.select("term").join(bounded(terms), "term", "left_semi")
    return materialize(seen.groupBy("term").agg(F.count(F.lit(1)).alias("n_seen")), "term-counts")


def _ranked(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """(win, n, r): the terms of each window that occur, rarest first, as structs of n_seen, term, off; at most ten."""
    met = windows.join(counts, "term")
    return met.groupBy("win", "n").agg(F.sort_array(F.collect_list(F.struct("n_seen", "term", "off"))).alias("r"))


def choose_anchors(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """(win, n, t1, o1, t2, o2): the two rarest terms of each window and their offsets (t2 is null in one-word windows); stored.

    A window with a term that no document has matches nowhere as a phrase and is left out.
    """
    first, second = F.get("r", F.lit(0)), F.get("r", F.lit(1))
    whole = _ranked(windows, counts).where(F.size("r") == F.col("n"))
    return materialize(whole.select("win", "n", first["term"].alias("t1"), first["off"].alias("o1"), second["term"].alias("t2"), second["off"].alias("o2")), "anchors")


def choose_pairs(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """(win, t1, t2): the two rarest different terms among those that documents have; windows with fewer than two have none. Stored."""
    seen = F.array_distinct(F.transform("r", lambda x: x["term"]))
    pairs = _ranked(windows, counts).select("win", F.get(seen, F.lit(0)).alias("t1"), F.get(seen, F.lit(1)).alias("t2"))
    return materialize(pairs.where("t2 is not null"), "pairs")


def _postings_of(index: DataFrame, chosen: DataFrame) -> DataFrame:
    """The stored postings of the terms t1 and t2."""
    terms = materialize(chosen.select(F.explode(F.array_compact(F.array("t1", "t2"))).alias("term")).distinct(), "chosen-terms")
    return materialize(index.join(bounded(terms), "term", "left_semi"), "chosen-postings")


def phrase_matches(index: DataFrame, windows: DataFrame, anchors: DataFrame) -> DataFrame:
    """(row, start, n, win): all exact occurrences of the windows; stored."""
    lists = _postings_of(index, anchors)
    rarest = lists.join(bounded(anchors), F.col("term") == F.col("t1"))
    starts = rarest.select("row", (F.col("place") - F.col("o1")).alias("start"), "t2", "o2", "win", "n").where("start >= 0")
    second = lists.select(F.col("term").alias("t2"), "row", (F.col("place")).alias("place2"))
    two = starts.where("t2 is not null").withColumn("place2", F.col("start") + F.col("o2")).join(second, ["t2", "row", "place2"], "left_semi")
    some = materialize(two.unionByName(starts.where("t2 is null").withColumn("place2", F.lit(None).cast("int"))).select("row", "start", "n", "win").distinct(), "candidates")
    # All terms of a candidate must stand in their places; only rows that have a candidate are looked at.
    places = some.join(bounded(windows.drop("n")), "win").select("row", (F.col("start") + F.col("off")).alias("place"), "term", "start", "n", "win")
    near = index.join(bounded(materialize(some.select("row").distinct(), "candidate-rows")), "row", "left_semi")
    met = places.join(near, ["row", "place", "term"]).groupBy("row", "start", "n", "win").agg(F.count(F.lit(1)).alias("met"))
    return materialize(met.where(F.col("met") == F.col("n")).drop("met"), "matches")


def _pair_distances(postings: DataFrame, pairs: DataFrame, span: int) -> DataFrame:
    """(t1, t2, row, distance): rows with both terms of a pair at most span words apart; the least distance.

    Postings are met per band of span places, so a frequent pair in one long text is not crossed with itself.
    """
    one = postings.join(bounded(pairs), F.col("term") == F.col("t1")).select("row", F.col("place").alias("p1"), "t1", "t2")
    one = one.withColumn("band", F.explode(F.expr(f"sequence(p1 div {span} - 1, p1 div {span} + 1)")))
    two = postings.select(F.col("term").alias("t2"), "row", F.col("place").alias("p2"), F.expr(f"place div {span}").alias("band"))
    near = one.join(two, ["t2", "row", "band"]).where((F.abs(F.col("p1") - F.col("p2")) <= span) & (F.col("p1") != F.col("p2")))
    return near.groupBy("t1", "t2", "row").agg(F.min(F.abs(F.col("p1") - F.col("p2"))).alias("distance"))


def near_matches(index: DataFrame, windows: DataFrame, counts: DataFrame, span: int = 20) -> DataFrame:
    """(win, row, distance): rows with the two rarest terms of a window, of those that occur, at most span words apart; the least distance.

    Windows that share their two terms (most neighbours do) are met once.
    """
    chosen = choose_pairs(windows, counts)
    pairs = materialize(chosen.select("t1", "t2").distinct(), "distinct-pairs")
    return _pair_distances(_postings_of(index, chosen), pairs, span).join(chosen, ["t1", "t2"]).select("win", "row", "distance")


def near_passages(
    docs: DataFrame, items: DataFrame, size: int = WINDOW, span: int = 20, key: str = "doc_id", text: str = "text", item: str = "item_id"
) -> DataFrame:
    """(key, item, distance): documents with the two rarest terms of one of the item's windows at most span words apart, and the
    least distance. Terms that no document has are passed over, so a passage with a changed word is found too."""
    windows, owners = benchmark_windows(items, size, item, text)
    rows = store_rows(docs, key, text)
    index = build_index(rows)
    found = near_matches(index, windows, term_counts(index, windows), span).join(owners, "win").groupBy("row", "item").agg(F.min("distance").alias("distance"))
    by_key = rows.select("row", "carried").join(found, "row")
    return by_key.groupBy(F.col("carried.key").alias(key), "item").agg(F.min("distance").alias("distance"))


def contamination(
    docs: DataFrame, items: DataFrame, size: int = WINDOW, key: str = "doc_id", text: str = "text", item: str = "item_id", extra: tuple = ()
) -> DataFrame:
    """(key, *extra, n_words, n_hit, n_items, items, contaminated) of every row of docs."""
    windows, owners = benchmark_windows(items, size, item, text)
    rows = store_rows(docs, key, text, extra)
    index = build_index(rows)
    matches = phrase_matches(index, windows, choose_anchors(windows, term_counts(index, windows)))
    n_words = materialize(index.groupBy("row").agg(F.count(F.lit(1)).alias("n_words")), "row-words")
    drop(index)
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))

    def cover(acc: Column, c: Column) -> Column:
        end = c["start"] + c["n"]
        new = F.greatest(end - F.greatest(acc["end"], c["start"]), F.lit(0))
        return F.struct((acc["n"] + new).cast("long").alias("n"), F.greatest(acc["end"], end).alias("end"))

    # Per row at most as many spans as it has words, and as many items as it has matches of.
    spans = matches.groupBy("row", "start").agg(F.max("n").alias("n")).groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "n"))).alias("s"))
    hits = spans.select("row", F.aggregate("s", zero, cover)["n"].alias("n_hit"))
    of_row = matches.select("row", "win").distinct().join(bounded(owners), "win").groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("items"))
    found = materialize(hits.join(of_row, "row"), "row-hits")
    out = rows.select("row", "carried").join(n_words, "row", "left").join(found, "row", "left")
    count = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    return out.select(
        F.col("carried.key").alias(key), *[F.col(f"carried.x{i}").alias(c) for i, c in enumerate(extra)], count(F.col("n_words")).alias("n_words"), count(F.col("n_hit")).alias("n_hit"),
        count(F.size("items").cast("long")).alias("n_items"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), (count(F.col("n_hit")) > 0).alias("contaminated"),
    )
