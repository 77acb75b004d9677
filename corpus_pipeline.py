"""A corpus pipeline over five of the training-data operators.

STAGES run in order, each on the written table of the stage before: quality rules drop rejected documents,
SimHash keeps one document of each near-duplicate group (op5's: three-word shingles, 3 differing bits),
suffix-array dedup cuts repeated passages out of the texts, decontamination drops documents that hold benchmark windows, and SentencePiece encodes
what is left. All stages but the last return the columns of documents, the last doc_id, n_pieces and ids.

Defined cases: a null or empty text is rejected by the quality rules; rows with equal ids and unlike texts are documents of their own; of repeated
rows one stays; null ids are kept; extra columns are carried up to the last stage; an empty table gives an empty table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofold.llm import decontaminate, quality_rules, sentence_pieces, simhash, suffix_dedup
from chronofold.llm.common import owned, read, release, scratch_path

PIECE_MODEL = "piece_bpe_32k.model"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_representatives(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cut


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    others = tuple(c for c in docs.columns if c != "doc_id")
    found = decontaminate.contamination(docs.select("doc_id", "text", F.struct(*[F.col(c) for c in others]).alias("_row")), read(spark, sf_dir, "benchmark"), extra=("_row",))
    return found.where(~F.col("contaminated")).select(*[c if c == "doc_id" else F.col("_row")[c].alias(c) for c in docs.columns])


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = sentence_pieces.load_pieces(public_tokenizers.path(PIECE_MODEL))
    encoded = sentence_pieces.encode_documents(docs, pieces)
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids")


OPERATORS = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_dedup),
    ("suffix-array dedup", suffix_array_dedup),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding", encoding),
]


def _stage(operator):
    """operator, with its scratch tables owned by the pipeline; those of the stage before, which is written by now, go first."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark, "pipeline")
        with owned("pipeline"):
            return operator(spark, docs, sf_dir)

    return run_stage


STAGES = [(name, _stage(operator)) for name, operator in OPERATORS]

#: The stages hash, refine and fold beyond what SQL can express; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline over the documents table. Its tables are its own: another run leaves them alone; a stage's scratch goes when the stage
    is written, the tables between stages and the last scratch when the driver ends."""
    docs, mine = read(spark, sf_dir, "documents"), f"pipeline {uuid.uuid4().hex}"
    for name, operator in OPERATORS[:-1]:
        with owned(f"{mine} tables"):
            path = scratch_path(spark, name.replace(" ", "-").lower())
        with owned(f"{mine} scratch"):
            operator(spark, docs, sf_dir).write.parquet(path)
        release(spark, f"{mine} scratch")
        docs = spark.read.parquet(path)
    with owned(f"{mine} last"):
        return OPERATORS[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL}
