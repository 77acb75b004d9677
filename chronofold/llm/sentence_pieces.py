"""SentencePiece encoding and decoding over a relational lattice.

A text becomes units: its spaces turn into U+2581, one is put in front, and it is cut where no piece of the
table reaches over: around white space, in front of every run of U+2581, and, if the table allows it (``load_pieces``
looks), between letters, digits and signs. A unit's pieces do not depend on its neighbours, so distinct units are encoded once:

1. documents are coded in blocks of about BLOCK_BYTES: a block stores for each document the numbers of its units, and the units
   that are new in its scope, which is the blocks of up to SCOPE_BYTES of one task; blocks are written once, bucketed by scope,
2. the distinct units of all scopes are numbered, their substrings of at most the longest piece's length exploded,
3. equi-joined to the piece table (bounded by the vocabulary, broadcast),
4. grouped by unit into the edges of its lattice,
5. folded with the higher-order ``aggregate``: ``viterbi_fold`` for unigram tables, ``merge_fold`` for BPE tables. A best
   path over BPE scores is not what a BPE model does, so Viterbi would give other pieces than the library,
6. joined back to the scopes' units, and gathered per block into the documents' ids.

``merge_fold`` visits each edge once, best piece first, and removes the boundary inside an edge that spans exactly two
tokens. That is the library's repeated choice of the best pair if no piece is built by way of a worse one;
``load_pieces`` builds every piece of the table to see that, and ``merge_steps`` repeats the choice for other tables.

Lattices of up to MAX_UNIT characters keep their boundaries in one long; longer units are folded in Arrow
batches by the same rules with a heap. No text and no block is shuffled, nothing that grows with the corpus is broadcast.

Characters without a piece become byte pieces (or unk where a table has none). Defined cases: null texts are
empty and have no pieces; repeated rows are encoded one by one; null and equal ids are kept; a text of more than
BLOCK_BYTES ends a block; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import functools
import heapq
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofold.llm.common import drop, materialize, materialize_by, opaque, text_or_empty

SPACE = "▁"
#: One bit per boundary of a unit, and one more for their number, fit into a signed long.
MAX_UNIT = 61
UNK_PENALTY = 10.0
BLOCK_BYTES, SCOPE_BYTES = 4 << 20, 64 << 20
#: The scopes' units meet their ids in so many rounds; each stores its result and frees its shuffle files before the next.
ROUNDS = 2
#: Units that one task makes lattices of.
TASK_UNITS = 20_000
#: An edge as one long: place of its piece in the order of scores, start, end, id.
ID_BITS, END_BITS = 20, 6
NO_ID = (1 << ID_BITS) - 1
#: White space, then either runs of anything else, or of letters (and whatever else is beyond U+00BF but for the signs of U+2000 to U+206F), one digit, and runs of signs.
COARSE = rf"{SPACE}*[^{SPACE} \t\n]+|{SPACE}+|[ \t\n]"
FINE = rf"{SPACE}*[A-Za-z\u00C0-\u1FFF\u2070-\u2580\u2582-\U0010FFFF]+|[0-9]|{SPACE}*[^{SPACE} \t\n0-9A-Za-z\u00C0-\u1FFF\u2070-\U0010FFFF]+|{SPACE}+|[ \t\n]"


@dataclass
class Pieces:
    """A piece table: ids and scores of normal pieces, byte pieces by value, how to fold, and where texts may be cut."""

    ids: dict[str, int]
    scores: dict[str, float]
    surface: list[bytes]
    first_byte: int | None
    unk: int
    fold: str
    units: str = COARSE
    longest: int = field(init=False)
    #: Whether no piece is built by way of a piece of a worse score.
    ordered: bool = field(init=False)

    def __post_init__(self):
        self.longest = max((len(p) for p in self.ids), default=1)
        self.ordered = self.fold == "merge" and all(_in_order(p, self) for p in self.ids)

    def rows(self) -> list[tuple[str, int, int, float]]:
        """(piece, id, place, score), place 0 for the best score."""
        place = {s: k for k, s in enumerate(sorted(set(self.scores.values()), reverse=True))}
        return [(p, i, place[self.scores[p]], self.scores[p]) for p, i in self.ids.items()]


def load_pieces(model: str, fold: str = "merge") -> Pieces:
    """The table of a SentencePiece model file; fold is "merge" for BPE and "viterbi" for unigram models."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    if sp.get_piece_size() >= NO_ID:
        raise ValueError(f"a table of {NO_ID} pieces or more does not fit an edge")
    ids, scores, surface, first = {}, {}, [], None
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            first = i if piece == "<0x00>" else first
            surface.append(bytes([int(piece[3:5], 16)]))
        elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            surface.append(b"" if sp.is_control(i) else " ⁇ ".encode())
        else:
            ids[piece], scores[piece] = i, sp.get_score(i)
            surface.append(piece.replace(SPACE, " ").encode())
    whole = [u for u in (FINE, COARSE) if all(p.strip(SPACE) == "" or re.fullmatch(u, p) for p in ids)]
    if not whole:
        raise ValueError("this table has pieces that cross unit boundaries")
    return Pieces(ids, scores, surface, first, sp.unk_id(), fold, whole[0])


def units_of(text: str, pattern: str = COARSE) -> list[str]:
    """The units of a text, in order."""
    return re.findall(pattern, SPACE + text.replace(" ", SPACE)) if text else []


def _bit(i: Column | int) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), i if isinstance(i, Column) else F.lit(i))


def _low(x: Column, shift: int, bits: int) -> Column:
    return F.call_function("shiftright", x, F.lit(shift)).bitwiseAND(F.lit((1 << bits) - 1)).cast("int")


def _start(x: Column) -> Column:
    return _low(x, ID_BITS + END_BITS, END_BITS)


def _end(x: Column) -> Column:
    return _low(x, ID_BITS, END_BITS)


def _ends(x: Column) -> Column:
    """The bits of both ends of an edge."""
    return _bit(_start(x)).bitwiseOR(_bit(_end(x)))


def _within(bits: Column, x: Column) -> Column:
    """The boundaries from an edge's start to its end, both included."""
    return bits.bitwiseAND(_bit(_end(x) + 1) - _bit(_start(x)))


def _spans_two(bits: Column, x: Column) -> Column:
    """Whether an edge spans exactly two tokens: both its ends are boundaries, and one place between them."""
    return (_within(bits, x).bitwiseAND(_ends(x)) == _ends(x)) & (F.bit_count(_within(bits, x)) == 3)


def _joined(bits: Column, x: Column) -> Column:
    """The boundaries without those inside an edge."""
    return (bits - _within(bits, x)).bitwiseOR(_ends(x))


def lattice(units: DataFrame, pieces: DataFrame, longest: int, parts: int) -> DataFrame:
    """(unit, n, edges) for a table of (uid, unit): edges as sorted longs, best pieces first; an edge with NO_ID is a
    character that no piece covers."""
    # Dealt by unit before it is exploded: the edges, many times the units, are grouped where they are made.
    dealt = units.repartition(parts, "uid").select("uid", "unit", F.length("unit").alias("n"))
    starts = dealt.select("uid", "unit", "n", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("s"))
    spans = starts.select("uid", "unit", "s", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), F.col("n") - F.col("s")))).alias("len"))
    cut = spans.select("uid", "unit", "s", "len", F.substring("unit", F.col("s") + 1, F.col("len")).alias("piece"))
    # The join meets hashes, which are one word long, and then the pieces themselves; no two pieces of a table share a hash.
    known = pieces.select(F.xxhash64("piece").alias("hash"), F.col("piece").alias("known"), "id", "place")
    met = cut.withColumn("hash", F.xxhash64("piece")).join(F.broadcast(known), "hash", "left")
    edges = met.withColumn("found", opaque(F.col("piece")) == F.col("known")).where("found or len = 1")
    place = F.when(F.col("found"), F.col("place")).otherwise((1 << 30) - 1)
    shifted = lambda c, by: F.call_function("shiftleft", c.cast("long"), F.lit(by))
    edge = shifted(place, ID_BITS + 2 * END_BITS) + shifted(F.col("s"), ID_BITS + END_BITS) + shifted(F.col("s") + F.col("len"), ID_BITS) + F.when(F.col("found"), F.col("id")).otherwise(NO_ID)
    grouped = edges.select("uid", "unit", edge.alias("edge")).groupBy("uid").agg(F.first("unit").alias("unit"), F.collect_list("edge").alias("edges"))
    return grouped.select("unit", F.length("unit").alias("n"), opaque(F.sort_array("edges")).alias("edges"))


def merge_fold(edges: Column, n: Column) -> Column:
    """Boundaries, as bits, after all merges, each edge visited once: for tables whose pieces are built in order."""

    step = lambda bits, x: F.when(_spans_two(bits, x), _joined(bits, x)).otherwise(bits)
    return F.aggregate(edges, _bit(n + 1) - 1, step)


def merge_steps(edges: Column, n: Column) -> Column:
    """The same for any table: each step takes the best edge over exactly two tokens, wherever it stands in the order."""

    def step(bits: Column, _: Column) -> Column:
        best = F.get(F.filter(edges, lambda x: _spans_two(bits, x)), F.lit(0))
        return F.when(best.isNull(), bits).otherwise(_joined(bits, best))

    return F.aggregate(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), _bit(n + 1) - 1, step)


def viterbi_fold(edges: Column, n: Column, scores: list[float], unknown: float) -> Column:
    """Boundaries, as bits, of the best-scored path; a character without a piece scores ``unknown``. scores: by place."""
    start = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(1).cast("long").alias("bits")))
    table = F.array(*[F.lit(float(s)) for s in scores])

    def step(best: Column, i: Column) -> Column:
        into = F.filter(edges, lambda x: _end(x) == i)
        own = lambda x: F.coalesce(F.get(table, F.call_function("shiftright", x, F.lit(ID_BITS + 2 * END_BITS)).cast("int")), F.lit(unknown))
        paths = F.transform(
            into,
            lambda x: F.struct(
                (F.get(best, _start(x))["score"] + own(x)).alias("score"),
                F.get(best, _start(x))["bits"].bitwiseOR(_bit(i)).alias("bits"),
            ),
        )
        return F.concat(best, F.array(F.array_max(paths)))

    return F.get(F.aggregate(F.sequence(F.lit(1), n), start, step), n)["bits"]


def with_ids(folded: DataFrame, first_byte: int | None, unk: int) -> DataFrame:
    """(unit, ids) of lattices with the boundaries of their tokens as bits."""
    taken = F.filter("edges", lambda x: _within(F.col("bits"), x) == _ends(x))
    ordered = F.sort_array(F.transform(taken, lambda x: x.bitwiseAND(F.lit((1 << ID_BITS + 2 * END_BITS) - 1))))
    staged = folded.select("unit", opaque(ordered).alias("ordered"))
    staged = staged.select("unit", "ordered", opaque(F.transform("ordered", lambda x: _low(x, 0, ID_BITS))).alias("plain"))

    def own(x: Column) -> Column:
        if first_byte is None:
            return F.array(F.when(_low(x, 0, ID_BITS) == NO_ID, F.lit(unk)).otherwise(_low(x, 0, ID_BITS)))
        char = F.encode(F.substring("unit", _start(x) + 1, F.lit(1)), "UTF-8")
        several = F.transform(F.sequence(F.lit(1), F.octet_length(char)), lambda k: F.conv(F.substring(F.hex(char), 2 * k - 1, F.lit(2)), 16, 10).cast("int") + first_byte)
        return F.when(_low(x, 0, ID_BITS) != NO_ID, F.array(_low(x, 0, ID_BITS))).otherwise(several)

    ids = F.when(F.array_contains("plain", NO_ID), F.flatten(F.transform("ordered", own))).otherwise(F.col("plain"))
    return staged.select("unit", ids.alias("ids"))


def _merges(unit: str, pieces: Pieces):
    """Start and end of every merge of a unit, by a heap, best piece first and leftmost of equals."""
    n = len(unit)
    right, left = list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n
    heap: list[tuple[float, int, int]] = []

    def offer(s: int) -> None:
        middle = right[s]
        if middle < n and right[middle] - s <= pieces.longest:
            score = pieces.scores.get(unit[s : right[middle]])
            if score is not None:
                heapq.heappush(heap, (-score, s, right[middle]))

    for s in range(n - 1):
        offer(s)
    while heap:
        worst, s, e = heapq.heappop(heap)
        if not alive[s] or right[s] >= n or right[right[s]] != e:
            continue
        alive[right[s]] = False
        right[s] = e
        if e < n:
            left[e] = s
        yield worst, s, e
        offer(s)
        if left[s] >= 0:
            offer(left[s])


def _in_order(piece: str, pieces: Pieces) -> bool:
    """Whether the merges of a piece on its own take pieces in the order of their scores, as far as it is built."""
    last = -np.inf
    for worst, _, _ in _merges(piece, pieces):
        if worst < last:
            return False
        last = worst
    return True


def fold_long(unit: str, pieces: Pieces) -> list[int]:
    """The same fold for a unit of any length: merges by a heap, or the best path by dynamic programming."""
    n = len(unit)
    if pieces.fold == "viterbi":
        low = min(pieces.scores.values()) - UNK_PENALTY
        best = [(0.0, 0)] + [(-np.inf, 0)] * n
        for i in range(1, n + 1):
            for s in range(max(0, i - pieces.longest), i):
                score = pieces.scores.get(unit[s:i], low if s == i - 1 else None)
                if score is not None and best[s][0] + score > best[i][0]:
                    best[i] = (best[s][0] + score, s)
        cuts = [n]
        while cuts[-1]:
            cuts.append(best[cuts[-1]][1])
        cuts.reverse()
    else:
        ends = {s: s + 1 for s in range(n)}
        for _, s, e in _merges(unit, pieces):
            ends.pop(ends[s])
            ends[s] = e
        cuts = [*sorted(ends), n]
    out: list[int] = []
    for s, e in zip(cuts, cuts[1:]):
        known = pieces.ids.get(unit[s:e])
        if known is not None:
            out.append(known)
        else:
            out += [pieces.unk] if pieces.first_byte is None else [b + pieces.first_byte for b in unit[s:e].encode("utf-8", "surrogatepass")]
    return out


def _fold_long_rows(pieces: Pieces):
    def run(batches):
        for batch in batches:
            ids = [fold_long(u, pieces) for u in batch.column("unit").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("unit"), pa.array(ids, pa.list_(pa.int32()))], names=["unit", "ids"])

    return run


def encode_units(units: DataFrame, pieces: Pieces) -> DataFrame:
    """(unit, ids) for a stored table of distinct (uid, unit)."""
    table = units.sparkSession.createDataFrame(pieces.rows(), "piece string, id int, place int, score double").drop("score")
    folded = lattice(units.where(F.length("unit") <= MAX_UNIT), table, pieces.longest, units.count() // TASK_UNITS + 1)
    if pieces.fold == "viterbi":
        scores = sorted(set(pieces.scores.values()), reverse=True)
        bits = viterbi_fold(F.col("edges"), F.col("n"), scores, scores[-1] - UNK_PENALTY)
    else:
        bits = (merge_fold if pieces.ordered else merge_steps)(F.col("edges"), F.col("n"))
    short_done = with_ids(folded.select("unit", "edges", opaque(bits).alias("bits")), pieces.first_byte, pieces.unk)
    long_done = units.where(F.length("unit") > MAX_UNIT).mapInArrow(_fold_long_rows(pieces), "unit string, ids array<int>")
    return short_done.unionByName(long_done)


def _planes(codes: np.ndarray) -> bytes:
    """Numbers as four planes of bytes, which pack better than whole numbers."""
    return codes.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unplanes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(4, -1).T).view("<i4").ravel()


def _slices(batch: pa.RecordBatch, rows: int = 512):
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def _coded(pattern: str, block_bytes: int, scope_bytes: int):
    """(key, text) -> one row per block: its keys, the number of units of each text, all units' numbers, the units that are new in
    the scope, and the number of the first of them."""

    def run(batches):
        from pyspark import TaskContext

        # With plain spaces the texts of most languages stay one byte a character here.
        find, scope = re.compile(pattern.replace(SPACE, " ")).findall, TaskContext.get().partitionId() << 32
        one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        known, spread, number = {}, 0, 0
        keys, codes, sizes, new, held = [], [], [], [], 0

        def block():
            cols = [
                pa.array([scope], pa.int64()), pa.array([number], pa.int32()), one(pa.concat_arrays(keys)), one(pa.array(sizes, pa.int32())), pa.array([_planes(np.concatenate(codes))], pa.binary()),
                pa.array([len(known) - len(new)], pa.int32()), one(pa.array(new, pa.string())),
            ]
            return pa.RecordBatch.from_arrays(cols, names=["scope", "part", "keys", "sizes", "codes", "base", "units"])

        # A few texts at a time, so a block ends soon after it is full and no list of words is long.
        for part in (x for batch in batches for x in _slices(batch, 256)):
            found = [find(" " + t.replace(SPACE, " ")) if t else [] for t in part.column("text").to_pylist()]
            coded = pa.array([u for own in found for u in own], pa.string()).dictionary_encode()
            here = coded.dictionary.to_pylist()
            for unit in here:
                if unit not in known:
                    known[unit] = len(known)
                    new.append(unit)
            codes.append(np.fromiter(map(known.__getitem__, here), dtype=np.int32, count=len(here))[coded.indices.to_numpy(zero_copy_only=False)])
            sizes += map(len, found)
            keys.append(part.column("key"))
            held += part.column("text").nbytes
            if held >= block_bytes:
                yield block()
                spread += held
                keys, codes, sizes, new, held, number = [], [], [], [], 0, number + 1
                if spread >= scope_bytes:
                    known, spread, scope, number = {}, 0, scope + 1, 0
        if sizes:
            yield block()

    return run


def _packed(batches):
    """(scope, code, ids) sorted by scope -> one row per scope: numbers, lengths and ids behind one another."""
    held, now = [], None

    def row():
        cols = [pa.array([now], pa.int64()), *[pa.array([_planes(np.concatenate(x))], pa.binary()) for x in zip(*held)]]
        return pa.RecordBatch.from_arrays(cols, names=["scope", "codes", "sizes", "ids"])

    for batch in batches:
        scope, code = batch.column("scope").to_numpy(), batch.column("code").to_numpy()
        offsets, values = batch.column("ids").offsets.to_numpy(), batch.column("ids").values.to_numpy(zero_copy_only=False)
        edges = np.concatenate([[0], np.flatnonzero(np.diff(scope)) + 1, [len(scope)]])
        for a, b in zip(edges, edges[1:]):
            if a < b and scope[a] != now:
                if held:
                    yield row()
                held, now = [], int(scope[a])
            if a < b:
                held.append((code[a:b], np.diff(offsets[a : b + 1]), values[offsets[a] : offsets[b]]))
    if held:
        yield row()


def _gathered(texts_of, most: int = 1 << 18):
    """(part, keys, sizes, codes, known) by scope and part -> one row per document; the first part of a scope brings known, the ids of
    its units by number. Documents of about ``most`` units are gathered together; texts_of decodes their ids if it is given."""

    def ids_by_number(known):
        number, lengths, values = (np.concatenate([np.empty(0, np.int32), *map(_unplanes, known.field(c).to_pylist())]) for c in ("codes", "sizes", "ids"))
        first, length = np.zeros(len(number), dtype=np.int64), np.zeros(len(number), dtype=np.int64)
        first[number], length[number] = np.cumsum(lengths) - lengths, lengths
        return values, first, length

    def run(batches):
        for row in (x for batch in batches for x in _slices(batch, 1)):
            keys, sizes = (row.column(c).flatten() for c in ("keys", "sizes"))
            codes = _unplanes(row.column("codes")[0].as_py())
            if row.column("part")[0].as_py() == 0:
                values, first, length = ids_by_number(row.column("known").flatten())
            units = np.concatenate([[0], np.cumsum(sizes.to_numpy())])
            at = 0
            while at < len(keys):
                to = max(int(np.searchsorted(units, units[at] + most)), at + 1)
                to = min(to, len(keys))
                own = codes[units[at] : units[to]]
                n = length[own]
                ends = np.concatenate([[0], np.cumsum(n)])
                ids = values[np.repeat(first[own] - ends[:-1], n) + np.arange(ends[-1])]
                bounds = ends[units[at : to + 1] - units[at]]
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
                more = {"text": texts_of(lists)} if texts_of else {}
                yield pa.RecordBatch.from_arrays([keys.slice(at, to - at), lists, *more.values()], names=["key", "ids", *more])
                at = to

    return run


def encode_documents(docs: DataFrame, pieces: Pieces, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES, scope_bytes: int = SCOPE_BYTES, decode: bool = False) -> DataFrame:
    """(key, ids) of every row: the piece ids that the model gives, without begin or end; with decode the text that the ids give, too."""
    texts = docs.select(F.col(key).alias("key"), text_or_empty(text).alias("text"))
    kind = texts.schema["key"].dataType.simpleString()
    coded = texts.mapInArrow(
        _coded(pieces.units, block_bytes, scope_bytes), f"scope long, part int, keys array<{kind}>, sizes array<int>, codes binary, base int, units array<string>"
    )
    blocks = materialize_by(coded, "coded-blocks", "scope")
    marked = F.translate("unit", " ", SPACE).alias("unit")
    distinct = blocks.select(F.explode("units").alias("unit")).select(marked).distinct()
    numbered = materialize(distinct.select(F.monotonically_increasing_id().alias("uid"), "unit"), "units")
    table = materialize(encode_units(numbered, pieces), "unit-table")
    drop(numbered)
    spread = blocks.select("scope", "base", F.posexplode("units").alias("at", "unit")).select("scope", (F.col("base") + F.col("at")).alias("code"), marked)
    rounds = []
    for turn in range(ROUNDS):
        mine = F.pmod(F.xxhash64("unit"), F.lit(ROUNDS)) == turn
        met = spread.where(mine).join(table.where(mine).hint("shuffle_hash"), "unit").select("scope", "code", "ids").sortWithinPartitions("scope")
        rounds.append(materialize(met.mapInArrow(_packed, "scope long, codes binary, sizes binary, ids binary"), "scope-ids"))
    drop(table)
    known = functools.reduce(DataFrame.unionByName, rounds).groupBy("scope").agg(F.collect_list(F.struct("codes", "sizes", "ids")).alias("known"))
    joined = blocks.select("scope", "part", "keys", "sizes", "codes").join(known, "scope", "left")
    nothing = F.array().cast("array<struct<codes:binary,sizes:binary,ids:binary>>")
    first = F.when(F.col("part") == 0, F.coalesce("known", nothing))
    whole = joined.select("scope", "part", "keys", "sizes", "codes", first.alias("known")).sortWithinPartitions("scope", "part")
    out = whole.mapInArrow(_gathered(_decoder(pieces) if decode else None), f"key {kind}, ids array<int>" + ", text string" * decode)
    return out.withColumnRenamed("key", key)


def decode_ids(ids, pieces: Pieces) -> str:
    """The text of piece ids; the space that encoding puts in front goes."""
    data = b"".join([pieces.surface[i] for i in ids]).decode("utf-8", "replace")
    return data[1:] if data.startswith(" ") else data


def _decoder(pieces: Pieces):
    """Lists of ids -> texts."""
    surface = pa.array(pieces.surface, pa.large_binary())

    def texts_of(ids: pa.ListArray) -> pa.Array:
        # The taken surfaces of all rows stand behind one another in one buffer.
        taken = surface.take(ids.flatten())
        _, places, data = taken.buffers()
        places, lengths = np.frombuffer(places, dtype=np.int64, count=len(taken) + 1), np.diff(ids.offsets.to_numpy())
        bounds = places[np.concatenate([[0], np.cumsum(lengths)])].tolist()
        view = memoryview(data) if data is not None else memoryview(b"")
        return pa.array([str(view[a + (view[a : a + 1] == b" ") : b], "utf-8", "replace") for a, b in zip(bounds, bounds[1:])], pa.string())

    return texts_of


def _decoded(texts_of):
    def run(batches):
        for batch in (x for whole in batches for x in _slices(whole)):
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("ids"), texts_of(batch.column("ids"))], names=["key", "ids", "text"])

    return run


def decode_documents(encoded: DataFrame, pieces: Pieces, key: str = "doc_id") -> DataFrame:
    """(key, ids, text): the decoded text of every row of ids."""
    rows = encoded.select(F.col(key).alias("key"), F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(_decoded(_decoder(pieces)), f"key {kind}, ids array<int>, text string").withColumnRenamed("key", key)
