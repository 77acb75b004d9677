"""Helpers shared by the training-data operators: shared scratch space and safe column access."""

from __future__ import annotations

import atexit
import contextlib
import contextvars
import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as the word rules of the operators name it.
ASCII_SPACE = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_scratch: dict[str, list[str]] = {}
#: Names of the scratch tables that the catalog knows, by path.
_tables: dict[str, str] = {}
_owner: contextvars.ContextVar[str] = contextvars.ContextVar("scratch owner", default="query")


@contextlib.contextmanager
def owned(owner: str):
    """Scratch tables made inside belong to owner."""
    token = _owner.set(owner)
    try:
        yield
    finally:
        _owner.reset(token)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where it is unset a local one, in local mode only."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = os.path.join(tempfile.gettempdir(), "chronofold-shared")
        os.makedirs(found, exist_ok=True)
        found = f"file://{found}"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    if path in _tables:
        spark.sql(f"DROP TABLE IF EXISTS {_tables.pop(path)}")
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, removed by release(owner) or when the driver ends."""
    path = f"{shared_dir(spark)}/chronofold-{label}-{uuid.uuid4().hex}"
    if not _scratch:
        atexit.register(_release_all, spark)
    _scratch.setdefault(_owner.get(), []).append(path)
    return path


def release(spark: SparkSession, owner: str = "query") -> None:
    """Remove the scratch tables of an owner; call it once their results have been written."""
    for path in _scratch.pop(owner, []):
        _delete(spark, path)


def drop(table: DataFrame) -> None:
    """Remove a materialized table that nothing reads any more."""
    for path in {p.rsplit("/", 1)[0] for p in table.inputFiles()}:
        for owned_paths in _scratch.values():
            for mine in [x for x in owned_paths if path.endswith(x.rsplit("/", 1)[-1])]:
                owned_paths.remove(mine)
                _delete(table.sparkSession, mine)


def _release_all(spark: SparkSession) -> None:
    try:
        for owner in list(_scratch):
            release(spark, owner)
    except Exception:  # noqa: BLE001  the JVM may have ended before Python
        _scratch.clear()


@contextlib.contextmanager
def clean_shuffles(spark: SparkSession):
    """Shuffle files of the writes inside go when each write ends, not at some later garbage collection."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """df as a written table in the shared folder: cuts its lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    with clean_shuffles(df.sparkSession):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_by(df: DataFrame, label: str, column: str) -> DataFrame:
    """df as a written table bucketed by column: a later join on it shuffles the other side only. Rows are written where they are."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    with clean_shuffles(spark):
        writer = df.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), column)
        writer.option("path", path).option("compression", "zstd").saveAsTable(name)
    _tables[path] = name
    return spark.table(name)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, UPPER, LOWER)


def text_or_empty(c: str | Column = "text") -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def space_words(text: Column) -> Column:
    """Words between ASCII white space, in order; an empty array for an empty text."""
    return F.filter(F.split(text, "[ \\t-\\r]+"), lambda w: w != "")


def opaque(c: Column) -> Column:
    """c, unchanged, as an expression that the optimizer neither copies into later steps nor evaluates twice.

    A filter over a costly projection is otherwise pushed below it with every expression written out.
    """
    return F.when(F.spark_partition_id() >= 0, c)
