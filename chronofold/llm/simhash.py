"""SimHash near-duplicates by segment popcounts.

A 64-bit fingerprint is cut into 32 two-bit segments; the vector of their bit counts is the embedding.
The Manhattan distance of two vectors never exceeds the Hamming distance of the fingerprints, so a range
join over vectors finds every pair within the limit. The join runs on a grid: the 32 coordinates form
six blocks, and vectors within distance 3 agree on at least three whole blocks, so each of the 20
choices of three blocks gives one grid cell to meet in. Pairs of a cell pass the Manhattan bound first, then
the exact bit count.

Only distinct fingerprints enter the join (copies share one), and a cell returns a spanning forest of its
links, at most one row per member. Cells larger than CELL_CHUNK are cut in chunks, and every pair of chunks
meets in its own group, so no group grows with a cell and no pair is lost. Components come from
alternating large-star and small-star rounds over the links, each a pair of shuffles with map-side minima.

Defined cases: null and empty texts have fingerprint zero and link like any other; a text with fewer than
three words is hashed as one shingle; repeated rows and copies share a component; equal doc_ids are
reported once per row; null ids are reported and never become a component's name unless all of its ids
are null; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import itertools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofold.llm.common import materialize, text_or_empty

SHINGLE = 3
SEED = 42
BLOCKS = ((0, 6), (6, 12), (12, 17), (17, 22), (22, 27), (27, 32))
CHOICES = tuple(itertools.combinations(range(len(BLOCKS)), 3))
CELL_CHUNK = 4096
#: Groups up to this size are linked together in one array pass, the others by a forest each.
SMALL = 4
_LOW = np.uint64(0x5555555555555555)
_WORDS = re.compile(rb"[^ \t-\r]+")
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str | None) -> int:
    """64-bit SimHash over the XXH64 values of word shingles, repeats included; 0 without words."""
    import xxhash

    words = _WORDS.findall((text or "").encode("utf-8", "surrogatepass").translate(_FOLD))
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(SHINGLE))))
    one = xxhash.xxh64_intdigest
    hashes = np.fromiter((one(s, SEED) for s in shingles), dtype="<u8")
    set_bits = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 8192):
        bits = np.unpackbits(hashes[at : at + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(batches):
    """The last column, text, gives way to fp."""
    for batch in batches:
        values = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], dtype=np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(values)], names=[*batch.schema.names[:-1], "fp"])


def popcount_segments(fp: np.ndarray) -> np.ndarray:
    """The embedding, packed: each two-bit lane holds the bit count (0 to 2) of its two-bit segment."""
    return (fp & _LOW) + ((fp >> np.uint64(1)) & _LOW)


def manhattan(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sum of absolute lane differences of packed embeddings. A lane holds 0 to 2, so |x-y| is the count of
    unary digits that differ: (x>=1) != (y>=1) plus (x>=2) != (y>=2)."""
    some = lambda v: (v | (v >> np.uint64(1))) & _LOW
    both = lambda v: (v >> np.uint64(1)) & _LOW
    return np.bitwise_count(some(a) ^ some(b)) + np.bitwise_count(both(a) ^ both(b))


def _cell_keys(fp: np.ndarray) -> np.ndarray:
    """(n, 20) grid cells: the lanes of three blocks, with the choice in the low bits."""
    packed = popcount_segments(fp)
    out = np.empty((len(fp), len(CHOICES)), dtype=np.uint64)
    for k, choice in enumerate(CHOICES):
        mask = np.uint64(sum(((1 << 2 * (hi - lo)) - 1) << 2 * lo for lo, hi in (BLOCKS[b] for b in choice)))
        mixed = (packed & mask) * np.uint64(0x9E3779B97F4A7C15)
        out[:, k] = ((mixed ^ (mixed >> np.uint64(29))) & ~np.uint64(31)) | np.uint64(k)
    return out


def _cells(batches):
    for batch in batches:
        fp = batch.column("fp").to_numpy(zero_copy_only=False)
        keys = _cell_keys(fp.view(np.uint64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.view(np.int64).ravel()), pa.array(np.repeat(fp, keys.shape[1]))], names=["cell", "fp"]
        )


class _Forest:
    """Union-find over positions; keeps the links that joined two trees."""

    def __init__(self, n: int):
        self.up = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        if a != b:
            self.up[max(a, b)] = min(a, b)
            self.links.append((i, j))


def _near(a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Index pairs (into a, into b) within most differing bits: Manhattan bound, then the exact test."""
    low = np.argwhere(manhattan(popcount_segments(a)[:, None], popcount_segments(b)[None, :]) <= most)
    exact = np.bitwise_count(a[low[:, 0]] ^ b[low[:, 1]]) <= most
    return low[exact]


def link_group(left: np.ndarray, right: np.ndarray | None, most: int) -> np.ndarray:
    """(k, 2) fingerprints: a spanning forest of the links among left, or between left and right."""
    everyone = left if right is None else np.concatenate([left, right])
    offset = 0 if right is None else len(left)
    forest = _Forest(len(everyone))
    step = 256
    for at in range(0, len(left), step):
        rest = left[at:] if right is None else right
        pairs = _near(left[at : at + step], rest, most)
        base = at if right is None else offset
        for i, j in pairs:
            if i + at != j + base:
                forest.join(int(i + at), int(j + base))
    return everyone[np.array(forest.links, dtype=np.int64).reshape(-1, 2)]


def _link_small(fp: np.ndarray, side: np.ndarray, size: np.ndarray, group: np.ndarray, most: int) -> np.ndarray:
    """The links of all groups of at most SMALL members at once."""
    out = [np.empty((0, 2), dtype=np.uint64)]
    for d in range(1, SMALL):
        a, b = fp[:-d], fp[d:]
        at = np.flatnonzero((group[:-d] == group[d:]) & (size[:-d] <= SMALL))
        at = at[manhattan(popcount_segments(a[at]), popcount_segments(b[at])) <= most]
        at = at[(np.bitwise_count(a[at] ^ b[at]) <= most) & (a[at] != b[at])]
        out.append(np.stack([a[at], b[at]], axis=1))
    return np.concatenate(out)


def _link_runs(most: int):
    """mapInArrow over rows sorted by (cell, chunks, side): one group at a time, never more than two chunks."""

    def groups(batches):
        held = None
        for batch in batches:
            got = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "pair", "side", "fp")]
            held = got if held is None else [np.concatenate(x) for x in zip(held, got)]
            new = np.flatnonzero((np.diff(held[0]) != 0) | (np.diff(held[1]) != 0)) + 1
            if len(new):
                yield [x[: new[-1]] for x in held], np.concatenate([[0], new])
                held = [x[new[-1] :] for x in held]
        if held is not None and len(held[0]):
            new = np.flatnonzero((np.diff(held[0]) != 0) | (np.diff(held[1]) != 0)) + 1
            yield held, np.concatenate([[0], new, [len(held[0])]])

    def run(batches):
        for (_, _, side, fp), edges in groups(batches):
            fp = fp.view(np.uint64)
            sizes = np.diff(edges)
            found = [_link_small(fp, side, np.repeat(sizes, sizes), np.repeat(np.arange(len(sizes)), sizes), most)]
            for k in np.flatnonzero(sizes > SMALL):
                own, which = fp[edges[k] : edges[k + 1]], side[edges[k] : edges[k + 1]]
                cross = which.any()
                found.append(link_group(own[which == 0], own[which == 1], most) if cross else link_group(own, None, most))
            pairs = np.concatenate(found).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["a", "b"])

    return run


def near_links(distinct: DataFrame, most: int = 3, chunk: int = CELL_CHUNK) -> DataFrame:
    """(a, b): links between distinct fingerprints (column fp) that connect all within most differing bits."""
    if most > 3:
        raise ValueError("the six-block grid is exact up to 3 differing bits")
    cells = distinct.select("fp").mapInArrow(_cells, "cell long, fp long")
    sizes = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    cells = cells.join(sizes, "cell")
    # A large cell is cut in c chunks; a member of chunk i joins the groups (i,0)..(i,c-1) as the lower or upper side.
    c = F.ceil(F.col("n") / chunk).cast("int")
    own = F.pmod(F.xxhash64("fp"), c).cast("int")
    cells = cells.select("cell", "fp", c.alias("c"), own.alias("own"))
    meet = F.explode(F.sequence(F.lit(0), F.col("c") - 1)).alias("other")
    spread = cells.select("cell", "fp", "own", "c", meet)
    spread = spread.select(
        "cell",
        (F.least("own", "other") * F.col("c") + F.greatest("own", "other")).cast("int").alias("pair"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
        "fp",
    )
    ordered = spread.repartition("cell", "pair").sortWithinPartitions("cell", "pair", "side", "fp")
    return ordered.mapInArrow(_link_runs(most), "a long, b long").where("a <> b").distinct()


def components(links: DataFrame, rounds: int = 40) -> DataFrame:
    """(node, root): the smallest node of each connected component, for nodes that have a link.

    Alternating large-star and small-star; only minima are aggregated, no neighbour list is built.
    """
    edges = links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi <> lo").distinct()
    edges = materialize(edges, "links")
    seen = None
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo"))).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        large = large.where("hi <> lo").distinct()
        lowest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(lowest, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        small = small.where("hi <> lo").union(lowest.select("hi", F.col("m").alias("lo"))).distinct()
        edges = materialize(small, "links")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.hash("hi", "lo").cast("decimal(20,0)")), F.bit_xor(F.xxhash64("hi", "lo"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))


def _prints(docs: DataFrame, key: str, text: str, **more: Column) -> DataFrame:
    """(key, *more, fp) of every row, stored."""
    rows = docs.select(F.col(key).alias("key"), *[c.alias(name) for name, c in more.items()], text_or_empty(text).alias("text"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return materialize(rows.mapInArrow(_fingerprints, f"{kinds}, fp long"), "fingerprints")


def _classes(firsts: DataFrame, most: int) -> DataFrame:
    """firsts (one row per fingerprint) with the root of each one's component."""
    roots = components(near_links(firsts, most))
    return firsts.join(roots, firsts.fp == roots.node, "left").select(*firsts.columns, F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, most: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp, component_id) of every row; fp is the signed 64-bit fingerprint."""
    prints = _prints(docs, key, text)
    classes = _classes(prints.groupBy("fp").agg(F.min("key").alias("first_key")), most)
    names = classes.groupBy("root").agg(F.min("first_key").alias("component_id"))
    named = classes.join(names, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(F.col("key").alias(key), "fp", "component_id")


def keep_representatives(docs: DataFrame, most: int = 3) -> DataFrame:
    """One row of each near-duplicate group: the row of the smallest doc_id (null ids last), of its texts the one of the
    smallest digest, any one of the rows that repeat both.

    An id and a text belong to one group only, so rows are chosen and met by both; an id alone may stand in several groups.
    """
    digest = F.md5(text_or_empty("text"))
    order = F.struct(F.col("key").isNull().alias("none"), "key", "digest")
    prints = _prints(docs, "doc_id", "text", digest=digest)
    firsts = prints.groupBy("fp").agg(F.min(order).alias("first"))
    chosen = _classes(firsts, most).groupBy("root").agg(F.min("first").alias("first"))
    chosen = materialize(chosen.select(F.col("first")["key"].alias("_key"), F.col("first")["digest"].alias("_digest")), "representatives")
    same = F.col("doc_id").eqNullSafe(F.col("_key")) & (digest == F.col("_digest"))
    kept = docs.join(chosen.hint("shuffle_hash"), same, "left_semi")
    repeated = prints.groupBy("key", "digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("key").alias("_key"), F.col("digest").alias("_digest"))
    if not repeated.head(1):
        return kept
    again = kept.join(repeated, same, "left_semi").withColumn("_digest", digest).dropDuplicates(["doc_id", "_digest"]).drop("_digest")
    return kept.join(repeated, same, "left_anti").unionByName(again)
