"""Exact removal of repeated byte strings by bucket-pointer refinement.

A byte goes if a string of ``length`` bytes that covers it also starts earlier (in a smaller id, or
earlier in the same document). A document is an id with a text, told apart by a 64-bit digest of the text: rows of one id
with unlike texts are documents of their own, none smaller than another. Suffixes are refined only where a repeat is possible:

1. Every window of ``length`` bytes is owned by the place of the least 32-gram hash inside it, which its
   bytes alone decide: equal windows have equal owners. Consecutive windows with one owner form a run.
   Runs whose owner's 32-gram occurs once in the corpus hold no repeat and are dropped.
2. Runs with equal bytes are merged by map-side minima: all but the first are repeats as a whole, except those of another text
   under the first one's id, which go on to the next step.
3. First runs that share their 32-gram with a different run are refined: buckets of 8-grams are split by
   sorting on (own bucket, bucket 8 bytes later), then 16, 32 and 36 bytes later, each step reusing the
   identifiers that the last one wrote; suffixes alone in their bucket leave the sort. At depth
   ``length`` a bucket holds equal windows; those of larger ids than its first and those behind one of their own document are
   repeats. A 32-gram with more than
   HOT_RUNS different runs is refined by aggregation over window digests instead, so no group is unbounded.
4. Repeated windows become spans per document, and spans are applied where the text is.

Defined cases: null texts are empty; texts shorter than ``length`` keep everything; a repeated row (same id
and text) is the same document, not a copy of it, and each row gets the same result; a null id counts as smaller than any
other and is otherwise an id like them; empty tables give empty tables; extra columns are carried by
``remove_repeats``. Texts are cut in segments for hashing, so memory does not follow the longest text's
hashes, and matches across segment ends are still found.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofold.llm.common import materialize, text_or_empty

LENGTH = 100
GRAM = 32
SEGMENT = 1 << 20
HOT_RUNS = 20_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_TABLE = np.random.default_rng(20240607).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """64-bit hashes of all grams (a power of two long), by doubling."""
    h, width = _TABLE[data], 1
    while width < gram:
        h = h[:-width] * _MIX + (h[width:] ^ (h[width:] >> np.uint64(29)))
        width *= 2
    h ^= h >> np.uint64(32)
    return h * _MIX


def owners(hashes: np.ndarray, width: int) -> np.ndarray:
    """Place of the least hash in each run of width hashes, the leftmost on ties."""
    best = (hashes & ~np.uint64(0xFFFFFF)) | np.arange(len(hashes), dtype=np.uint64)
    span = 1
    while 2 * span <= width:
        best = np.minimum(best[:-span], best[span:])
        span *= 2
    rest = width - span
    if rest:
        best = np.minimum(best[:-rest], best[rest:])
    return (best & np.uint64(0xFFFFFF)).astype(np.int64)


def _segments(texts: list[str | None], length: int):
    """(row, base, bytes): texts of at least length bytes, packed or cut to about SEGMENT bytes; segments of one
    text overlap by length - 1 bytes, so each window lies in exactly one."""
    for row, text in enumerate(texts):
        data = (text or "").encode("utf-8", "surrogatepass")
        for base in range(0, max(len(data) - length + 1, 0), SEGMENT):
            yield row, base, data[base : base + SEGMENT + length - 1]


def _packed(texts, length: int):
    """Groups of segments, about SEGMENT bytes together."""
    held, size = [], 0
    for s in _segments(texts, length):
        held.append(s)
        size += len(s[2])
        if size >= SEGMENT:
            yield held
            held, size = [], 0
    if held:
        yield held


def window_runs(texts: list[str | None], length: int = LENGTH, digests: bool = True):
    """Yields (row, gram, digest, start, n): runs of n consecutive windows with one owner, as arrays."""
    import xxhash

    for group in _packed(texts, length):
        blob = b"".join(s[2] for s in group)
        sizes = np.array([len(s[2]) for s in group])
        begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        hashes = gram_hashes(np.frombuffer(blob, dtype=np.uint8))
        own = owners(hashes, length - GRAM + 1)
        place = np.arange(len(own))
        seg = np.searchsorted(begins, place, side="right") - 1
        valid = place + length <= begins[seg] + sizes[seg]
        place, own, seg = place[valid], own[valid], seg[valid]
        cut = np.flatnonzero((np.diff(own) != 0) | (np.diff(seg) != 0)) + 1
        at = np.concatenate([[0], cut])
        n = np.diff(np.concatenate([at, [len(place)]]))
        lo, s = place[at], seg[at]
        gram = hashes[own[at]]
        digest = None
        if digests:
            one, ends = xxhash.xxh3_64_intdigest, (lo + n + length - 1).tolist()
            digest = np.fromiter((one(blob[a:b]) for a, b in zip(lo.tolist(), ends)), dtype=np.uint64, count=len(lo))
        rows, bases = np.array([x[0] for x in group]), np.array([x[1] for x in group])
        yield rows[s], gram, digest, lo - begins[s] + bases[s], n


def _batch(columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v) for v in columns.values()], names=list(columns))


def _gram_counts(length: int):
    def run(batches):
        for batch in batches:
            for _, gram, _, _, _ in window_runs(batch.column("text").to_pylist(), length, digests=False):
                kinds, n = np.unique(gram.view(np.int64), return_counts=True)
                yield _batch({"gram": kinds, "n": n.astype(np.int64)})

    return run


def _runs(length: int):
    def run(batches):
        for batch in batches:
            keys = batch.column("key")
            for rows, gram, digest, start, n in window_runs(batch.column("text").to_pylist(), length):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(gram.view(np.int64)),
                        pa.array(digest.view(np.int64)),
                        keys.take(pa.array(rows)),
                        pa.array(start.astype(np.int64)),
                        pa.array(n.astype(np.int32)),
                    ],
                    names=["gram", "digest", "key", "start", "n"],
                )

    return run


def _cut_runs(length: int):
    """(key, text, runs) -> one row per run with its bytes."""

    def run(batches):
        import xxhash

        for batch in batches:
            texts, runs = (batch.column(c).to_pylist() for c in ("text", "runs"))
            out = []
            for row, (text, own) in enumerate(zip(texts, runs)):
                data = (text or "").encode("utf-8", "surrogatepass")
                for r in own:
                    piece = data[r["start"] : r["start"] + r["n"] + length - 1]
                    if np.uint64(xxhash.xxh3_64_intdigest(piece)).astype(np.int64) == r["digest"]:
                        out.append((r["gram"], row, r["start"], piece))
            cols = list(zip(*out)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), batch.column("key").take(pa.array(cols[1], pa.int64())), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.binary())],
                names=["gram", "key", "start", "piece"],
            )

    return run


def refine(blob: bytes, sizes: np.ndarray, length: int = LENGTH, ids: np.ndarray | None = None, docs: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Bucket-pointer refinement over the concatenated pieces, which stand in order of their ids and, in those, of their documents.

    Returns (place, repeated) for every window start: whether an equal window starts at a smaller place, in a piece of another
    id or of the same document. ids and docs: numbers of each piece's id and document; without them no two pieces share an id.
    """
    data = np.frombuffer(blob, dtype=np.uint8)
    ends = np.repeat(np.cumsum(sizes), sizes)
    place = np.arange(len(data))
    room = ends - place
    # Buckets of 8-grams; places without room for one never feed a full window.
    words = np.zeros(len(data), dtype=np.uint64)
    for k in range(8):
        words[: len(data) - k] = (words[: len(data) - k] << np.uint64(8)) | data[k:].astype(np.uint64)
    bucket = np.full(len(data), -1, dtype=np.int64)
    active, depth = place[room >= 8], 8
    keys = words[active]
    while True:
        _, codes, counts = np.unique(keys, return_inverse=True, return_counts=True)
        # New identifiers start beyond all old ones; a place alone in its bucket keeps a pointer of its own.
        bucket[active] = codes + bucket.max() + 1
        if depth == length:
            break
        active = active[counts[codes] > 1]
        step = min(depth, length - depth)
        depth += step
        active = active[room[active] >= depth]
        _, dense = np.unique(bucket, return_inverse=True)
        bucket = dense.astype(np.int64)
        keys = bucket[active] * np.int64(len(data) + 1) + bucket[active + step]
    repeated = np.zeros(len(data), dtype=bool)
    order = active[np.argsort(bucket[active], kind="stable")]
    same = np.concatenate([[False], np.diff(bucket[order]) == 0])[: len(order)]
    if ids is not None and len(order):
        piece = np.searchsorted(np.cumsum(sizes), order, side="right")
        first = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
        own = np.concatenate([[False], docs[piece[1:]] == docs[piece[:-1]]])
        same &= own | (ids[piece] != ids[piece[first]])
    repeated[order[same]] = True
    starts = place[room >= length]
    return starts, repeated[starts]


def _refine_groups(length: int, most: int = 2 << 20):
    """mapInArrow over runs sorted by (gram, key, start): whole grams at a time, about ``most`` bytes together."""

    def spans(gram, ident, digest, start, piece, kind):
        fresh = [i for i in range(len(gram)) if not i or (gram[i], ident[i], digest[i], start[i]) != (gram[i - 1], ident[i - 1], digest[i - 1], start[i - 1])]
        sizes = np.array([len(piece[i]) for i in fresh], dtype=np.int64)
        # Numbers that change with the id and with the document.
        steps = [(gram[i] != gram[j] or ident[i] != ident[j], digest[i] != digest[j]) for j, i in zip(fresh, fresh[1:])]
        ids = np.cumsum([0, *(s[0] for s in steps)])
        docs = np.cumsum([0, *(s[0] or s[1] for s in steps)])
        at, repeated = refine(b"".join(piece[i] for i in fresh), sizes, length, ids, docs)
        begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        at = at[repeated]
        own = np.searchsorted(begins, at, side="right") - 1
        cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(own) != 0)) + 1
        first, last = at[np.concatenate([[0], cut])] if len(at) else at, at[np.concatenate([cut - 1, [len(at) - 1]])] if len(at) else at
        own = np.searchsorted(begins, first, side="right") - 1
        base = np.array([start[i] for i in fresh], dtype=np.int64)[own] - begins[own] if len(own) else own
        keys = [{"id": ident[fresh[i]], "digest": digest[fresh[i]]} for i in own]
        return pa.RecordBatch.from_arrays([pa.array(keys, kind), pa.array(first + base, pa.int64()), pa.array(last + base + length, pa.int64())], names=["key", "start", "end"])

    def run(batches):
        held, size = [[], [], [], [], []], 0
        for batch in batches:
            kind = batch.schema.field("key").type
            key = batch.column("key")
            cols = [c.to_pylist() for c in (batch.column("gram"), key.field("id"), key.field("digest"), batch.column("start"), batch.column("piece"))]
            for row in zip(*cols):
                if size >= most and row[0] != held[0][-1]:
                    yield spans(*held, kind)
                    held, size = [[], [], [], [], []], 0
                for to, value in zip(held, row):
                    to.append(value)
                size += len(row[4])
        if held[0]:
            yield spans(*held, kind)

    return run


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """docs with ``key``, the document of each row: its id and the digest of its text."""
    return docs.select(F.struct(F.col(key).alias("id"), F.xxhash64(text_or_empty(text)).alias("digest")).alias("key"), *[F.col(c).alias(f"_{c}") for c in docs.columns])


def repeated_spans(docs: DataFrame, length: int = LENGTH, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, spans): byte spans [start, end) of each document (its id and text digest) that repeat earlier bytes; documents without any are absent."""
    texts = _keyed(docs, key, text).select("key", text_or_empty(f"_{text}").alias("text"))
    kind = texts.schema["key"].dataType.simpleString()
    counted = texts.select("text").mapInArrow(_gram_counts(length), "gram long, n long")
    # Written, so that both sides of the next join are dealt out by it and a hot gram can be split there.
    repeated = materialize(counted.groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1").select("gram"), "repeated-grams")
    runs = texts.mapInArrow(_runs(length), f"gram long, digest long, key {kind}, start long, n int")
    shared = materialize(runs.join(repeated, "gram"), "runs")

    firsts = shared.groupBy("gram", "digest").agg(F.min(F.struct("key", "start", "n")).alias("f"), F.count(F.lit(1)).alias("copies"))
    firsts = materialize(firsts.select("gram", "digest", "f.*", "copies"), "first-runs")
    many = firsts.where("copies > 1").select("gram", "digest", F.col("key").alias("key0"), F.col("start").alias("start0"))
    rival = F.col("key.id").eqNullSafe(F.col("key0.id")) & (F.col("key.digest") != F.col("key0.digest"))
    same = (F.col("key") == F.col("key0")) & (F.col("start") == F.col("start0"))
    whole = shared.join(many, ["gram", "digest"]).where(~same & ~rival)
    whole = whole.select("key", "start", (F.col("start") + F.col("n") + (length - 1)).alias("end"))

    pieces = firsts.select("key", "gram", "digest", "start", "n")
    texts_of = shared.groupBy(F.col("key.id").alias("id0")).agg(F.min("key.digest").alias("low"), F.max("key.digest").alias("high"))
    twins = materialize(texts_of.where("low <> high").select("id0"), "shared-ids")
    if not twins.isEmpty():
        met = shared.join(twins, F.col("key.id").eqNullSafe(F.col("id0"))).join(many, ["gram", "digest"])
        pieces = pieces.unionByName(met.where(rival).select("key", "gram", "digest", "start", "n"))
    kinds = pieces.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    mixed = pieces.join(kinds, "gram").select("key", "gram", "digest", "start", "n", "kinds")
    wanted = mixed.groupBy("key").agg(F.collect_list(F.struct("gram", "digest", "start", "n")).alias("runs"))
    carried = texts.join(wanted.hint("shuffle_hash"), "key").select("key", "text", "runs")
    pieces = materialize(carried.mapInArrow(_cut_runs(length), f"gram long, key {kind}, start long, piece binary"), "pieces")
    pieces = pieces.join(kinds, "gram")
    cold = pieces.where(F.col("kinds") <= HOT_RUNS).select("gram", "key", "start", "piece")
    cold = cold.repartition("gram").sortWithinPartitions("gram", "key", "start")
    partly = cold.mapInArrow(_refine_groups(length), f"key {kind}, start long, end long")
    spans = whole.unionByName(partly).unionByName(_hot_spans(pieces.where(F.col("kinds") > HOT_RUNS), length))
    return materialize(spans.groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("spans")), "spans")


def _hot_spans(pieces: DataFrame, length: int) -> DataFrame:
    """Repeated windows of grams with very many different runs, by aggregation over window digests."""
    offsets = F.sequence(F.lit(0), F.octet_length("piece") - length)
    windows = pieces.select("key", "start", "piece").distinct().select("key", "start", "piece", F.explode(offsets).alias("t"))
    windows = windows.select("key", (F.col("start") + F.col("t")).alias("start"), F.unhex(F.md5(F.substring("piece", F.col("t") + 1, F.lit(length)))).alias("win"))
    own = windows.groupBy("win", "key").agg(F.min("start").alias("own0"))
    first = own.groupBy("win").agg(F.min(F.struct("key")).alias("f"))
    later = windows.join(own, ["win", "key"]).join(first, "win")
    later = later.where(~F.col("key.id").eqNullSafe(F.col("f.key.id")) | (F.col("start") > F.col("own0")))
    return later.select("key", "start", (F.col("start") + length).alias("end"))


def merge_spans(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs of covered bytes, in order; touching spans are one run."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((s["start"], s["end"]) for s in spans or ()):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _kept(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for s in spans for x in s), len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))


def _whole_characters(data: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans shrunk to whole UTF-8 characters."""
    out = []
    for a, b in spans:
        while a < b and data[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(data) and data[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def _apply(mode: str):
    def run(batches):
        for batch in batches:
            keys, texts, spans = batch.column("key"), batch.column("text").to_pylist(), batch.column("spans").to_pylist()
            out = []
            for text, own in zip(texts, spans):
                data = (text or "").encode("utf-8", "surrogatepass")
                runs = [(a, min(b, len(data))) for a, b in merge_spans(own) if a < len(data)]
                if mode == "digest":
                    rest = _kept(data, runs)
                    out.append((len(data), len(data) - len(rest), len(runs), hashlib.sha256(rest).hexdigest()))
                else:
                    out.append((_kept(data, _whole_characters(data, runs)).decode("utf-8", "replace") if runs else text,))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string()) if mode == "digest" else (pa.string(),)
            names = ["n_bytes", "n_removed", "n_spans", "kept_sha256"] if mode == "digest" else ["_new"]
            cols = [pa.array([r[i] for r in out], kinds[i]) for i in range(len(kinds))]
            carried = [] if mode == "digest" else [batch.column("row")]
            yield pa.RecordBatch.from_arrays([keys, *carried, *cols], names=["key", *(["row"] if carried else []), *names])

    return run


def span_digests(docs: DataFrame, length: int = LENGTH, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    spans = repeated_spans(docs, length, key, text)
    texts = _keyed(docs, key, text).select("key", text_or_empty(f"_{text}").alias("text"))
    joined = texts.join(spans.hint("shuffle_hash"), "key", "left").select(F.col("key.id").alias("key"), "text", "spans")
    kind = joined.schema["key"].dataType.simpleString()
    out = joined.mapInArrow(_apply("digest"), f"key {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return out.withColumnRenamed("key", key)


def remove_repeats(docs: DataFrame, length: int = LENGTH, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with every repeated span cut from text, in whole characters; other columns are kept as they are."""
    spans = repeated_spans(docs, length, key, text)
    others = [c for c in docs.columns if c not in (key, text)]
    row = F.struct(*[F.col(f"_{c}").alias(c) for c in others]) if others else F.lit(None).cast("string")
    packed = _keyed(docs, key, text).select("key", F.col(f"_{text}").alias("text"), row.alias("row"))
    joined = packed.join(spans.hint("shuffle_hash"), "key", "left").select(F.col("key.id").alias("key"), "row", "text", "spans")
    kind, row = joined.schema["key"].dataType.simpleString(), joined.schema["row"].dataType.simpleString()
    out = joined.mapInArrow(_apply("text"), f"key {kind}, row {row}, _new string")
    origin = {key: F.col("key"), text: F.col("_new")}
    return out.select(*[(origin[c] if c in origin else F.col("row")[c]).alias(c) for c in docs.columns])
