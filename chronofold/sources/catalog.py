"""A catalog of stored data: one row per dataset in a manifest table, found by run, type and lineage.

Folders follow scope/aa/bb/name, sharded by the md5 of the identifier. A dataset counts as stored only if every chunk file that its
manifest row lists is there. A remote store is read only, copies a dataset on demand, and refuses the heavy types unless told otherwise.
"""

from __future__ import annotations

import hashlib
import json
import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofold.plans.engine import DataNotAvailable, config_hash

MANIFEST = "run_id string, data_type string, lineage_hash string, lineage string, location string, chunks array<string>, n_bytes long"
KEY = ("run_id", "data_type", "lineage_hash")


def shard_path(root: str, scope: str, name: str) -> str:
    h = hashlib.md5(f"{scope}:{name}".encode()).hexdigest()
    return f"{root.rstrip('/')}/{scope}/{h[:2]}/{h[2:4]}/{name}"


def without(lineage: dict, types: Sequence[str], options: Sequence[str]) -> dict:
    """A lineage {type: [operator, version, options]} less whole types and less options of the others."""
    return {t: [o, v, {k: x for k, x in opts.items() if k not in options}] for t, (o, v, opts) in lineage.items() if t not in types}


class Catalog:
    """The manifest below root, appended to on each registration; the last row of a key holds."""

    def __init__(self, spark: SparkSession, root: str, readonly: bool = False):
        self.spark, self.root, self.readonly = spark, root.rstrip("/"), readonly
        self.manifest_path = f"{self.root}/_manifest"

    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def exists(self, path: str) -> bool:
        fs, p = self._fs(path)
        return fs.exists(p)

    def files(self, path: str) -> list[tuple[str, int]]:
        fs, p = self._fs(path)
        return sorted((s.getPath().getName(), s.getLen()) for s in fs.listStatus(p) if s.getPath().getName().endswith(".parquet"))

    def manifest(self) -> DataFrame:
        if not self.exists(self.manifest_path):
            return self.spark.createDataFrame([], f"{MANIFEST}, seq long")
        rows = self.spark.read.schema(f"{MANIFEST}, seq long").parquet(self.manifest_path)
        return rows.groupBy(*KEY).agg(*[F.max_by(c, "seq").alias(c) for c in rows.columns if c not in KEY])

    def save(self, df: DataFrame, run_id: str, data_type: str, lineage: dict, scope: str = "exp") -> str:
        """Writes a dataset and registers it; its location."""
        if self.readonly:
            raise PermissionError(f"{self.root} is read only")
        digest = config_hash(lineage)
        path = shard_path(self.root, f"{scope}_{run_id}", f"{data_type}-{digest}")
        df.write.mode("overwrite").parquet(path)
        self.register(run_id, data_type, lineage, path)
        return path

    def register(self, run_id: str, data_type: str, lineage: dict, path: str) -> None:
        found = self.files(path)
        seq = (self.manifest().agg(F.max("seq")).first()[0] or 0) + 1
        row = (run_id, data_type, config_hash(lineage), json.dumps(lineage, sort_keys=True), path, [n for n, _ in found], sum(b for _, b in found), seq)
        self.spark.createDataFrame([row], f"{MANIFEST}, seq long").coalesce(1).write.mode("append").parquet(self.manifest_path)

    def is_complete(self, row) -> bool:
        return self.exists(row.location) and {n for n, _ in self.files(row.location)} >= set(row.chunks)

    def find(self, run_id: str, data_type: str, lineage: dict, fuzzy_types: Sequence[str] = (), fuzzy_options: Sequence[str] = ()) -> str:
        """Location of a whole dataset. With fuzzy types or options, those may differ; a warning says what was taken."""
        rows = self.manifest().where((F.col("run_id") == run_id) & (F.col("data_type") == data_type)).orderBy(F.col("seq").desc()).collect()
        for r in rows:
            if r.lineage_hash == config_hash(lineage) and self.is_complete(r):
                return r.location
        if fuzzy_types or fuzzy_options:
            wanted = without(json.loads(json.dumps(lineage)), fuzzy_types, fuzzy_options)
            for r in rows:
                if without(json.loads(r.lineage), fuzzy_types, fuzzy_options) == wanted and self.is_complete(r):
                    warnings.warn(f"{data_type} of run {run_id} is taken from {r.location}", stacklevel=2)
                    return r.location
        raise DataNotAvailable(f"{data_type} of run {run_id}")

    def find_several(self, keys: DataFrame) -> DataFrame:
        """keys (run_id, data_type, lineage_hash) with their location, null where there is none."""
        return keys.join(self.manifest().select(*KEY, "location"), list(KEY), "left")

    def runs_with(self, data_type: str) -> DataFrame:
        return self.manifest().where(F.col("data_type") == data_type).select("run_id").distinct()


class RemoteStore:
    """A catalog elsewhere: datasets are copied into a folder that all executors share, read there, and removed with release()."""

    def __init__(self, catalog: Catalog, cache: str, heavy: Sequence[str] = ("raw_records", "records"), allow_heavy: bool = False):
        self.catalog, self.cache, self.heavy, self.allow_heavy = catalog, cache.rstrip("/"), tuple(heavy), allow_heavy

    def _copy(self, data_type: str, source: str) -> str:
        return f"{self.cache}/{hashlib.md5(source.encode()).hexdigest()[:12]}-{data_type}"

    def read(self, run_id: str, data_type: str, lineage: dict) -> DataFrame:
        if not self.allow_heavy and any(data_type.startswith(h) for h in self.heavy):
            raise DataNotAvailable(f"{data_type} is too large to be copied")
        source = self.catalog.find(run_id, data_type, lineage)
        path = self._copy(data_type, source)
        if not self.catalog.exists(f"{path}/_SUCCESS"):
            self.catalog.spark.read.parquet(source).write.mode("overwrite").parquet(path)
        return self.catalog.spark.read.parquet(path)

    def release(self, run_id: str, data_type: str, lineage: dict) -> None:
        fs, p = self.catalog._fs(self._copy(data_type, self.catalog.find(run_id, data_type, lineage)))
        fs.delete(p, True)
