"""Session factory and table loading shared by queries, tests and the bench."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_pinned: list[tuple[SparkSession, str]] = []


def get_session(app: str = "chronofold", cores: str | int | None = None, shuffle_partitions: int = 8) -> SparkSession:
    """The active session, or a local one with UTC time, AQE and Arrow switched on."""
    cores = cores or os.environ.get("BENCH_CPUS") or "*"
    return (
        SparkSession.builder.appName(app)
        .master(f"local[{cores}]")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("CHRONOFOLD_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables; any path that Spark's readers open will do."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where it is unset a local one, in local mode only."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"file://{tempfile.gettempdir()}/chronofold-shared"


def pinned(df: DataFrame) -> DataFrame:
    """df as a written table in the shared folder, computed once for all the branches of a plan that read it. It cuts the plan and survives
    lost executors. unpin() removes it, the driver's end does too."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/chronofold-pinned-{uuid.uuid4().hex}"
    if not _pinned:
        atexit.register(unpin)
    _pinned.append((spark, path))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unpin() -> None:
    """Removes what pinned() has written; call it once the results have been read."""
    while _pinned:
        spark, path = _pinned.pop()
        try:
            target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # noqa: BLE001  the JVM may have ended before Python
            _pinned.clear()
