"""Token counts through a digest cache.

The cache is a Parquet table keyed by tokenizer digest and content digest. A run digests every text,
left-joins the digests to the stored counts, encodes each distinct miss once, appends the new counts,
and joins the counts back to the rows. Digests of equal texts are merged by map-side aggregation before
anything is shuffled, and a text travels once, only if it stands for a miss.

Counts are those of the library of the named tokenizer file, special strings inside texts being special tokens (its default). Files that hold
plain byte-level BPE run in a faster encoder with the same vocabulary, all others in the library itself; ``tests/llm`` hold both
against that library.

Defined cases: a null text counts as the empty text (0 tokens); repeated rows and copies are counted once
and reported for each row; a null id is kept; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import json

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofold.llm.common import opaque, scratch_path, text_or_empty

#: The split pattern of byte-level BPE files without one of their own (fixed value).
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@functools.cache
def _byte_of_char() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use for the 256 bytes."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def _is_plain_byte_level(spec: dict) -> bool:
    """Whether a tokenizer file says nothing but what tiktoken does with the same vocabulary: byte-level BPE with the usual split, no
    normalizer, merges in the order of their results' ids, special tokens that are matched as they stand."""
    model, pre, post = spec.get("model", {}), spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    if post is not None or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or pre.get("use_regex") is False:
        return False
    if model.get("type", "BPE") != "BPE" or model.get("dropout") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix") or model.get("ignore_merges"):
        return False
    if any(not t.get("special") or t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in spec.get("added_tokens", [])):
        return False
    vocab = model["vocab"]
    ids = [vocab.get("".join(m if isinstance(m, list) else m.split(" "))) for m in model["merges"]]
    byte = _byte_of_char()
    return None not in ids and ids == sorted(set(ids)) and all(c in vocab for c in byte) and max(vocab[c] for c in byte) < ids[0]


@functools.cache
def load_encoder(path: str):
    """text -> number of tokens. Plain byte-level BPE files run in tiktoken, which is faster; all others in their own library."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    if not _is_plain_byte_level(spec):
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        library.no_truncation()
        library.no_padding()
        return lambda text: len(library.encode(text, add_special_tokens=False).ids)
    import tiktoken

    byte = _byte_of_char()
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", []) if t.get("special")}
    ranks = {bytes(byte[c] for c in piece): rank for piece, rank in spec["model"]["vocab"].items() if piece not in special}
    encoding = tiktoken.Encoding(path, pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return lambda text: len(encoding.encode(text, allowed_special="all"))


def tokenizer_digest(path: str) -> str:
    """SHA-256 of the tokenizer file and of the library that runs it: a changed version never meets old counts."""
    import tiktoken
    import tokenizers

    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + f"\0tiktoken {tiktoken.__version__} tokenizers {tokenizers.__version__}".encode()).hexdigest()


def count_in_batches(tokenizer: str):
    """mapInArrow function (digest, text) -> (digest, n_tokens)."""

    def run(batches):
        encoder = load_encoder(tokenizer)
        done: set[bytes] = set()  # of this task; a row that is there twice meets itself here
        for batch in batches:
            digests, counts = [], []
            for digest, text in zip(batch.column("digest").to_pylist(), batch.column("text").to_pylist()):
                if digest not in done:
                    done.add(digest)
                    digests.append(digest)
                    counts.append(encoder(text))
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(counts, pa.int64())], names=["digest", "n_tokens"])

    return run


def _stored(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """Counts of one tokenizer version in the cache; no rows before the first append."""
    schema = "digest binary, n_tokens long"
    path = f"{cache}/tokenizer={version}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def count_tokens(
    docs: DataFrame, tokenizer: str, cache: str | None = None, key: str = "doc_id", text: str = "text", limit: int = 512
) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) of every row; misses are encoded once and appended to the cache.

    tokenizer: path of the .json file on every executor. cache: folder of the stored counts, the session's
    scratch folder if not given. Appending is idempotent: a digest stored twice by racing runs has one
    count, and reads take it once.
    """
    spark = docs.sparkSession
    cache = cache or scratch_path(spark, "token-cache")
    version = tokenizer_digest(tokenizer)
    body = text_or_empty(text)
    keyed = docs.select(
        F.col(key).alias("key"),
        F.octet_length(body).cast("long").alias("n_bytes"),
        opaque(F.unhex(F.sha2(body, 256))).alias("digest"),
        body.alias("text"),
    )
    # One row stands for each missing digest; digests and keys alone decide which.
    known = _stored(spark, cache, version).select("digest").distinct()
    first = keyed.groupBy("digest").agg(F.min("key").alias("first_key")).join(known, "digest", "left_anti")
    first = first.withColumnRenamed("digest", "first_digest").hint("shuffle_hash")
    same = (F.col("digest") == F.col("first_digest")) & F.col("key").eqNullSafe(F.col("first_key"))
    misses = keyed.select("key", "text", "digest").join(first, same, "left_semi")
    counted = misses.select("digest", "text").mapInArrow(count_in_batches(tokenizer), "digest binary, n_tokens long")
    counted.write.mode("append").parquet(f"{cache}/tokenizer={version}")
    counts = _stored(spark, cache, version).groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))
    out = keyed.select("key", "n_bytes", "digest").join(counts, "digest")
    return out.select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
