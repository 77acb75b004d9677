"""Edit-distance join of names by simultaneous traversal of two tries.

All pairs of a left and a right name whose optimal-string-alignment distance (insert, delete, substitute one code point,
exchange two adjacent ones, no substring edited twice) is at most ``distance``:

1. Names are made distinct. Both sides' prefixes up to a depth are the upper levels of their tries, kept as tables.
2. Both upper tries are traversed together, one level a round: a pair of nodes is expanded by an equi-join with the children of
   each, and lives on while the edit automaton allows it, that is while some cell on the edge of its distance matrix is
   within the bound. What is left are pairs of subtrees.
3. Left subtrees are dealt to groups by their first ``depth`` code points, with all right names whose subtree met one of them. A
   group with more than ``most`` names of a side is cut into blocks by a hash of the names, and each block of one side meets
   each of the other, so no group is unbounded and none is dropped.
4. In a group the names of each side become a minimal acyclic automaton (prefixes and suffixes shared). Both are
   traversed together: a state is (left node, right node, edits left), visited once however many names lead to it; states that
   cannot end in two names are cut off, and the rest give the pairs with their least cost.

The depth is the least at which at most half of the left names are in groups of over four blocks. Every join is a shuffle: nothing that
grows with the names is broadcast, collected or put into one task.

Defined cases: null and empty names take no part; repeated names count once; names of any length and any characters are
compared by code points as stored; an empty side gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofold.llm.common import materialize

DEEPEST = 12
MOST = 250
#: Remaining lengths of a node as bits; the top bit stands for all lengths from there on.
_BITS, _LONG = (1 << 64) - 1, 1 << 63


def alive(left: list[str], right: list[str], distance: int) -> np.ndarray:
    """For each pair of prefixes: whether words that begin with them can be within distance, by the least cell on the edge of the matrix."""
    m, n = np.array([len(x) for x in left]), np.array([len(x) for x in right])
    wide = max(int(m.max(initial=1)), int(n.max(initial=1)), 1)
    a = np.array(left, dtype=f"U{wide}").view(np.uint32).reshape(len(left), wide)
    b = np.array(right, dtype=f"U{wide}").view(np.uint32).reshape(len(right), wide)
    far = np.full(len(left), distance + 1, dtype=np.int16)
    cells: dict[tuple[int, int], np.ndarray] = {}
    best = far
    for i in range(wide + 1):
        for j in range(max(0, i - distance), min(wide, i + distance) + 1):
            if not i or not j:
                cell = np.full(len(left), i + j, dtype=np.int16)
            else:
                cell = np.minimum(cells.get((i - 1, j), far), cells.get((i, j - 1), far)) + np.int16(1)
                cell = np.minimum(cell, cells[i - 1, j - 1] + (a[:, i - 1] != b[:, j - 1]))
                if i > 1 and j > 1:
                    crossed = (a[:, i - 1] == b[:, j - 2]) & (a[:, i - 2] == b[:, j - 1])
                    cell = np.where(crossed, np.minimum(cell, cells[i - 2, j - 2] + 1), cell)
            cells[i, j] = cell
            edge = ((m == i) & (j <= n)) | ((n == j) & (i <= m))
            best = np.where(edge, np.minimum(best, cell), best)
    return best <= distance


def _living(distance: int):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(alive(batch.column("u").to_pylist(), batch.column("v").to_pylist(), distance)))

    return run


class Automaton:
    """The minimal acyclic automaton of sorted, different words. edges[node]: character -> (node, words passed over)."""

    def __init__(self, words: list[str]):
        self.edges: list[dict[str, tuple[int, int]]] = []
        self.final: list[bool] = []
        self.count: list[int] = []
        self.lengths: list[int] = []
        known: dict[tuple, int] = {}

        def settle(node: list) -> int:
            key = (node[0], *node[1])
            if key not in known:
                known[key] = len(self.edges)
                passed, lengths, edges = int(node[0]), int(node[0]), {}
                for c, child in node[1]:
                    edges[c] = (child, passed)
                    passed += self.count[child]
                    lengths |= (self.lengths[child] << 1 & _BITS) | self.lengths[child] & _LONG
                self.edges.append(edges)
                self.final.append(node[0])
                self.count.append(passed)
                self.lengths.append(lengths)
            return known[key]

        path, last = [[False, []]], ""
        for word in [*words, ""]:
            same = 0
            while same < min(len(last), len(word)) and last[same] == word[same]:
                same += 1
            for i in range(len(last), same, -1):
                node = settle(path.pop())
                path[-1][1].append((last[i - 1], node))
            path.extend([False, []] for _ in word[same:])
            path[-1][0] |= bool(word)
            last = word
        self.root = settle(path[0])


def _widened(lengths: int, by: int) -> int:
    for _ in range(by):
        lengths |= (lengths << 1 & _BITS) | lengths >> 1 | lengths & _LONG
    return lengths


def matches(left: list[str], right: list[str], distance: int) -> dict[tuple[int, int], int]:
    """(place in left, place in right) -> distance, for sorted lists of different words."""
    a, b = Automaton(left), Automaton(right)
    ea, eb, span = a.edges, b.edges, distance + 1
    room = [[_widened(x, e) for x in b.lengths] for e in range(span)]
    lengths = a.lengths

    def steps(x: int, y: int, e: int):
        """(left node, right node, edits left, left words passed, right words passed) after one move."""
        if not e:
            for c, (p, i) in ea[x].items():
                if c in eb[y]:
                    q, j = eb[y][c]
                    if lengths[p] & room[0][q]:
                        yield p, q, 0, i, j
            return
        less, same = room[e - 1], room[e]
        for c, (p, i) in ea[x].items():
            if lengths[p] & less[y]:
                yield p, y, e - 1, i, 0
            for d, (q, j) in eb[y].items():
                if c == d:
                    if lengths[p] & same[q]:
                        yield p, q, e, i, j
                else:
                    if lengths[p] & less[q]:
                        yield p, q, e - 1, i, j
                    if d in ea[p] and c in eb[q]:
                        (p2, i2), (q2, j2) = ea[p][d], eb[q][c]
                        if lengths[p2] & less[q2]:
                            yield p2, q2, e - 1, i + i2, j + j2
        for q, j in eb[y].values():
            if lengths[x] & less[q]:
                yield x, q, e - 1, 0, j

    start = (a.root, b.root, distance)
    came: dict[tuple[int, int, int], list] = {start: []}
    open_, ends = [start], []
    while open_:
        state = open_.pop()
        if a.final[state[0]] and b.final[state[1]]:
            ends.append(state)
        for p, q, e, _, _ in steps(*state):
            if (p, q, e) in came:
                came[p, q, e].append(state)
            else:
                came[p, q, e] = [state]
                open_.append((p, q, e))
    useful, open_ = set(ends), ends
    while open_:
        for before in came[open_.pop()]:
            if before not in useful:
                useful.add(before)
                open_.append(before)
    found: dict[tuple[int, int], int] = {}
    walks, seen = [(*start, 0, 0)] if start in useful else [], set()
    while walks:
        x, y, e, i, j = walks.pop()
        if a.final[x] and b.final[y]:
            found[i, j] = min(found.get((i, j), distance), distance - e)
        for p, q, f, i2, j2 in steps(x, y, e):
            walk = (p, q, f, i + i2, j + j2)
            if (p, q, f) in useful and walk not in seen:
                seen.add(walk)
                walks.append(walk)
    return found


def _meet(distance: int):
    """mapInArrow over rows sorted by (node, block, other, side, name): whole groups at a time."""

    def pairs(names: tuple[list[str], list[str]]):
        found = matches(*names, distance) if all(names) else {}
        lefts, rights = [names[0][i] for i, _ in found], [names[1][j] for _, j in found]
        return pa.RecordBatch.from_arrays([pa.array(lefts, pa.string()), pa.array(rights, pa.string()), pa.array(list(found.values()), pa.int32())], names=["l", "r", "distance"])

    def run(batches):
        group, names = None, ([], [])
        for batch in batches:
            for node, block, other, side, name in zip(*(batch.column(c).to_pylist() for c in ("node", "block", "other", "side", "name"))):
                if group != (node, block, other):
                    if all(names):
                        yield pairs(names)
                    group, names = (node, block, other), ([], [])
                names[side].append(name)
        if all(names):
            yield pairs(names)

    return run


def _distinct(df: DataFrame, name: str) -> DataFrame:
    return df.select(F.col(name).cast("string").alias("name")).where("name <> ''").distinct()


def _start(name: str, depth: int | Column) -> Column:
    return F.substring(F.col(name), F.lit(1), F.lit(depth) if isinstance(depth, int) else depth)


def _prefixes(names: DataFrame) -> DataFrame:
    """(depth, node, n): the nodes of the upper trie with the number of names below; a name that has ended stays as it is."""
    each = names.select("name", F.explode(F.sequence(F.lit(1), F.lit(DEEPEST))).alias("depth"))
    return each.groupBy("depth", _start("name", F.col("depth")).alias("node")).agg(F.count(F.lit(1)).alias("n"))


def similar_names(left: DataFrame, right: DataFrame, left_name: str = "name", right_name: str = "name", distance: int = 2, most: int = MOST) -> DataFrame:
    """(l, r, distance): every pair of different-or-equal names of both sides within distance, once."""
    a, b = materialize(_distinct(left, left_name), "left-names"), materialize(_distinct(right, right_name), "right-names")
    upper, lower = materialize(_prefixes(a), "left-nodes"), materialize(_prefixes(b), "right-nodes")
    crowded = F.sum(F.when(F.col("n") > 4 * most, F.col("n")).otherwise(0)) / F.sum("n")
    shared = {r["depth"]: r["crowded"] for r in upper.groupBy("depth").agg(crowded.alias("crowded")).collect()}
    depth = next((k for k in range(2, DEEPEST - 1) if shared.get(k, 0) <= 0.5), DEEPEST - 2)
    deep = depth + 2

    level = lambda nodes, k, own: nodes.where(F.col("depth") == k + 1).select(_start("node", k).alias(own), F.col("node").alias(f"{own}2"))
    met = level(upper, 0, "u").join(level(lower, 0, "v").withColumnRenamed("v", "u").hint("shuffle_hash"), "u").select(F.col("u2").alias("u"), F.col("v2").alias("v"))
    for k in range(1, deep):
        met = met.join(level(upper, k, "u").hint("shuffle_hash"), "u").join(level(lower, k, "v").hint("shuffle_hash"), "v")
        met = met.select(F.col("u2").alias("u"), F.col("v2").alias("v")).mapInArrow(_living(distance), "u string, v string")
    met = materialize(met.select(_start("u", depth).alias("node"), "v").distinct(), "subtree-pairs")

    size = lambda nodes, k, own, out: nodes.where(F.col("depth") == k).select(F.col("node").alias(own), F.col("n").alias(out))
    blocks = lambda n: F.ceil(F.col(n) / most).cast("int")
    # Written, so that the next join deals both sides anew and a crowded node can be split there.
    rights = materialize(met.join(size(lower, deep, "v", "n").hint("shuffle_hash"), "v").groupBy("node").agg(F.sum("n").alias("nb")), "right-sizes")
    groups = rights.join(size(upper, depth, "node", "na").hint("shuffle_hash"), "node").select("node", blocks("na").alias("blocks"), blocks("nb").alias("others"))
    groups = materialize(groups, "groups")
    part = lambda n: F.pmod(F.xxhash64("name"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    one = a.withColumn("node", _start("name", depth)).join(groups.hint("shuffle_hash"), "node")
    one = one.select("node", part("blocks").alias("block"), every("others").alias("other"), F.lit(0).alias("side"), "name")
    two = b.withColumn("v", _start("name", deep)).join(met.join(groups.hint("shuffle_hash"), "node").hint("shuffle_hash"), "v")
    two = two.select("node", every("blocks").alias("block"), part("others").alias("other"), F.lit(1).alias("side"), "name")
    order = ["node", "block", "other", "side", "name"]
    dealt = one.unionByName(two).repartition(*order[:3]).sortWithinPartitions(*order)
    return dealt.mapInArrow(_meet(distance), "l string, r string, distance int")


def misspelt(name: Column, key: Column) -> Column:
    """name with two adjacent code points exchanged where the crc32 h of the decimal key is even: those at h mod (L - 1) and after it."""
    h, size = F.crc32(key.cast("string").cast("binary")), F.length(name)
    at = (h % (size - 1)).cast("int")
    part = lambda start, n: F.substring(name, start, n)
    turned = F.concat(part(F.lit(1), at), part(at + 2, F.lit(1)), part(at + 1, F.lit(1)), part(at + 3, size))
    return F.when((h % 2 == 0) & (size >= 2), turned).otherwise(name)


def link_vendors(clients: DataFrame, vendors: DataFrame, distance: int = 2) -> DataFrame:
    """(vendor_id, distance, n_clients, first_client_id, clients_crc) of each vendor and exact distance with a pair.

    clients: client_id, name; vendors: vendor_id, name (as it is to be joined). Rows of clients count each, null ids with no crc; a repeated
    vendor row counts once, and vendors with one id and unlike names get rows of their own.
    """
    crc = F.crc32(F.col("client_id").cast("string").cast("binary"))
    named = clients.select("client_id", F.col("name").cast("string").alias("l")).where("l <> ''")
    named = named.groupBy("l").agg(F.count(F.lit(1)).alias("n"), F.min("client_id").alias("first"), F.coalesce(F.sum(crc), F.lit(0)).alias("crc"))
    pairs = similar_names(clients, vendors, distance=distance)
    sums = pairs.join(named.hint("shuffle_hash"), "l").groupBy("r", "distance").agg(F.sum("n").alias("n_clients"), F.min("first").alias("first_client_id"), F.sum("crc").alias("clients_crc"))
    known = vendors.select("vendor_id", F.col("name").cast("string").alias("r")).where("r <> ''").distinct()
    return known.join(sums.hint("shuffle_hash"), "r").select("vendor_id", "distance", "n_clients", "first_client_id", "clients_crc")
