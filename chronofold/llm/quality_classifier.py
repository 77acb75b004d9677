"""Document quality by random Fourier features.

1. ``document_statistics``: bounded statistics of each whole text (no id, language or source among them).
2. Means and deviations over all documents standardise them.
3. Random Fourier features cos(w x + b) with fixed seed approximate a Gaussian kernel.
4. Normal equations are summed per partition over all labelled training rows; the sums, whose size depends
   on the number of features alone, meet in SLOTS groups and then on the driver, which solves the ridge system.
5. Isotonic calibration pools adjacent violators over a fixed grid of score bins.

Defined cases: null and empty texts have statistics of an empty text and are scored; rows whose id has
several labels take the largest; null ids are scored and count as not held out; repeated rows are scored one by one; without
training rows every score is 0.5; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofold.llm.common import materialize, text_or_empty

FEATURES, RIDGE, SEED, BINS, SLOTS = 256, 1e-3, 7, 1000, 8
FOLDS = 5
THRESHOLD = 0.3
STATISTICS = (
    "log_words", "log_chars", "mean_word", "upper", "digit", "punctuation", "symbol", "pipe", "bang", "quote", "wide", "lines_per_word",
    "line_copies", "word_kinds", "top_word", "adjacent", "triple_copies", "short_words", "long_words", "sentence_ends",
)


def _classes() -> np.ndarray:
    table = np.zeros((256, 8))
    for c in range(256):
        ch = chr(c)
        table[c, 0] = c < 128 and ch.isupper()
        table[c, 1] = c < 128 and ch.isdigit()
        table[c, 2] = ch in ".,;:?'-()"
        table[c, 3] = ch in "#*$%&<>@^~={}[]\\/_+"
        table[c, 4] = ch == "|"
        table[c, 5] = ch == "!"
        table[c, 6] = ch in "\"'`"
        table[c, 7] = c >= 128
    return table


_CLASSES = _classes()


def statistics(text: str | None) -> list[float]:
    """STATISTICS of one text; every value is finite and bounded by logarithms or shares."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = (text or "").split()
    n, size = max(len(words), 1), max(len(data), 1)
    share = (np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256) @ _CLASSES) / size
    lines = [x for x in (text or "").split("\n") if x.strip()]
    kinds = Counter(words)
    lengths = [len(w) for w in kinds.elements()]
    triples = max(len(words) - 2, 0)
    distinct = len(set(zip(words, words[1:], words[2:])))
    return [
        np.log1p(len(words)), np.log1p(len(data)), min(sum(lengths) / n, 50.0), *share[:8].tolist(), len(lines) / n,
        1 - len(set(lines)) / max(len(lines), 1), len(kinds) / n**0.75, max(kinds.values(), default=0) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n, 1 - distinct / max(triples, 1) if triples else 0.0,
        sum(x <= 2 for x in lengths) / n, sum(x > 14 for x in lengths) / n, (data.count(b".") + data.count(b"?")) / n,
    ]


def _statistic_rows(batches):
    for batch in batches:
        values = [statistics(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("held_out"), pa.array(values, pa.list_(pa.float64()))], names=["key", "held_out", "x"]
        )


def document_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, x): statistics of every row; held_out if crc32 of the id as text is divisible by FOLDS."""
    fold = F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))
    rows = docs.select(F.col(key).alias("key"), fold.alias("held_out"), text_or_empty(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(_statistic_rows, f"key {kind}, held_out boolean, x array<double>")


class Fourier:
    """Standardised random Fourier features with a constant."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray, features: int = FEATURES, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.mean, self.deviation = mean, np.where(deviation > 1e-9, deviation, 1.0)
        self.w = rng.normal(size=(len(mean), features)) / np.sqrt(len(mean))
        self.b = rng.uniform(0, 2 * np.pi, features)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.deviation, -8, 8)
        return np.hstack([np.sqrt(2 / len(self.b)) * np.cos(z @ self.w + self.b), np.ones((len(x), 1))])


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _partial_sums(fourier: Fourier):
    def run(batches):
        from pyspark import TaskContext

        total = None
        for batch in batches:
            if batch.num_rows:
                phi = fourier(_matrix(batch))
                both = np.hstack([phi, batch.column("y").to_numpy(zero_copy_only=False)[:, None]])
                part = both.T @ both
                total = part if total is None else total + part
        if total is not None:
            slot = TaskContext.get().partitionId() % SLOTS
            yield pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["slot", "sums"])

    return run


def _merge_sums(batches):
    total = None
    for batch in batches:
        for raw in batch.column("sums").to_pylist():
            part = np.frombuffer(raw)
            total = part.copy() if total is None else total + part
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])


def fit_ridge(train: DataFrame, fourier: Fourier, ridge: float = RIDGE) -> np.ndarray:
    """Weights from normal equations summed per partition; train has x and y."""
    sums = train.select("x", "y").mapInArrow(_partial_sums(fourier), "slot int, sums binary")
    merged = sums.repartition(SLOTS, "slot").select("sums").mapInArrow(_merge_sums, "sums binary").collect()
    if not merged:
        return np.zeros(len(fourier.b) + 1)
    side = len(fourier.b) + 2
    total = sum(np.frombuffer(r["sums"]).reshape(side, side) for r in merged)
    gram, target = total[:-1, :-1], total[:-1, -1]
    rows = gram[-1, -1]
    penalty = ridge * rows * np.eye(side - 1)
    penalty[-1, -1] = 1e-9 * rows
    return np.linalg.solve(gram + penalty, target)


def pool_adjacent_violators(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The nondecreasing sequence of least weighted squared distance to value."""
    blocks: list[list[float]] = []
    for v, w in zip(value, weight):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, n2 = blocks.pop()
            v1, w1, n1 = blocks[-1]
            blocks[-1] = [(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2]
    return np.concatenate([np.full(int(n), v) for v, _, n in blocks]) if blocks else np.empty(0)


def _raw(fourier: Fourier, weights: np.ndarray, batch: pa.RecordBatch) -> np.ndarray:
    return np.clip(fourier(_matrix(batch)) @ weights, -1.0, 2.0) if batch.num_rows else np.empty(0)


def _binned(fourier: Fourier, weights: np.ndarray):
    def run(batches):
        for batch in batches:
            at = np.floor((_raw(fourier, weights, batch) + 1.0) / 3.0 * BINS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at), batch.column("y")], names=["bin", "y"])

    return run


def fit_calibration(train: DataFrame, fourier: Fourier, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(raw score, calibrated score) knots for linear interpolation; at most BINS + 1 of them."""
    bins = train.select("x", "y").mapInArrow(_binned(fourier, weights), "bin long, y double").groupBy("bin")
    rows = sorted(bins.agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("y")).collect())
    if not rows:
        return np.array([0.0]), np.array([0.5])
    at, n, y = (np.array(c, dtype=float) for c in zip(*rows))
    return (at + 0.5) / BINS * 3.0 - 1.0, pool_adjacent_violators(y, n)


def _scored(fourier: Fourier, weights: np.ndarray, knots: tuple[np.ndarray, np.ndarray]):
    def run(batches):
        for batch in batches:
            score = np.clip(np.interp(_raw(fourier, weights, batch), *knots), 0.0, 1.0)
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("held_out"), pa.array(np.round(score, 6))], names=["key", "held_out", "score"])

    return run


def score_documents(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """(key, held_out, score, predicted) of every row, learnt from the labelled rows that are not held out."""
    stats = materialize(document_statistics(docs, key, text), "statistics")
    k = len(STATISTICS)
    moments = stats.agg(*[f(F.get("x", F.lit(i))).alias(f"{n}{i}") for i in range(k) for n, f in (("m", F.avg), ("d", F.stddev_pop))]).first()
    mean, deviation = (np.array([moments[f"{n}{i}"] or 0.0 for i in range(k)]) for n in "md")
    fourier = Fourier(mean, deviation)
    marks = labels.groupBy(F.col(key).alias("key")).agg(F.max(F.col(label)).cast("double").alias("y")).where("y is not null")
    train = materialize(stats.where(~F.col("held_out")).join(marks, "key").select("x", "y"), "train")
    weights = fit_ridge(train, fourier)
    knots = fit_calibration(train, fourier, weights)
    kind = stats.schema["key"].dataType.simpleString()
    out = stats.mapInArrow(_scored(fourier, weights, knots), f"key {kind}, held_out boolean, score double")
    return out.select(F.col("key").alias(key), "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
