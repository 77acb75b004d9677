"""A small engine over registered data types: dependencies, lineage-keyed tables, selections and named queries.

A data type is provided by a function of its dependencies' DataFrames and a configuration. Its lineage is the hash of
its version, the options it takes and the lineages below it; a stored table is used if its lineage
matches, so only what is missing is planned. Everything is lazy: asking for a type composes a plan.
"""

from __future__ import annotations

import enum
import hashlib
import json
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofold.operators.intervals import select_time
from chronofold.operators.ordered import match


class SaveWhen(enum.IntEnum):
    NEVER = 0
    EXPLICIT = 1
    TARGET = 2
    ALWAYS = 3


@dataclass(frozen=True)
class Operator:
    """kind: what a row is; types of one kind have the same rows and can be joined. key: the columns that name a row of the kind (its
    time, if that is enough)."""

    provides: str
    depends_on: tuple[str, ...]
    compute: Callable[..., DataFrame]
    version: str = "0"
    options: dict = field(default_factory=dict)
    save_when: SaveWhen = SaveWhen.TARGET
    kind: str | None = None
    key: tuple[str, ...] = ("run_id", "time")


class DataNotAvailable(LookupError):
    """A type is neither stored nor may it be made."""


def config_hash(value) -> str:
    return hashlib.sha1(json.dumps(value, sort_keys=True, default=str).encode()).hexdigest()[:16]


def run_name(number: int | str) -> str:
    return f"{int(number):06d}"


def dataset_path(root: str, run_id: str, data_type: str, lineage: str) -> str:
    """root/aa/bb/run-type-lineage, sharded by the md5 of the identifier."""
    did = f"{run_id}:{data_type}-{lineage}"
    h = hashlib.md5(did.encode()).hexdigest()
    return f"{root.rstrip('/')}/{h[:2]}/{h[2:4]}/{run_id}-{data_type}-{lineage}"


def rewrite_selection(selection: str | Sequence[str]) -> str:
    """numexpr-style conditions as SQL: & | ~ == become AND OR NOT =; several conditions are joined by AND."""
    if not isinstance(selection, str):
        return " AND ".join(f"({rewrite_selection(s)})" for s in selection)
    return re.sub(r"~", " NOT ", re.sub(r"\s*\|\s*", " OR ", re.sub(r"\s*&\s*", " AND ", selection.replace("==", "="))))


class Engine:
    """Registry, stores (first hit wins) and named queries."""

    def __init__(self, spark: SparkSession, config: dict | None = None, stores: Sequence[dict] = (), forbid: Sequence[str] = ()):
        self.spark, self.config, self.forbid = spark, dict(config or {}), set(forbid)
        self.stores = [{"path": s, "readonly": False, "take_only": None} if isinstance(s, str) else {"readonly": False, "take_only": None, **s} for s in stores]
        self.operators: dict[str, Operator] = {}
        self.named: dict[str, tuple[tuple[str, ...], Callable]] = {}

    def register(self, *operators: Operator) -> None:
        for o in operators:
            self.operators[o.provides] = o

    def operator(self, provides: str, depends_on: Sequence[str] = (), **more):
        """Decorator: a function (dependencies..., **options) -> DataFrame as a data type."""
        def add(f):
            self.register(Operator(provides, tuple(depends_on), f, **more))
            return f

        return add

    def options_of(self, name: str) -> dict:
        o = self.operators[name]
        return {k: self.config.get(k, v) for k, v in o.options.items()}

    def lineage(self, name: str) -> dict:
        o = self.operators[name]
        return {"name": name, "version": o.version, "options": self.options_of(name), "below": [self.lineage(d) for d in o.depends_on]}

    def key(self, name: str) -> str:
        return config_hash(self.lineage(name))

    def dependency_tree(self, name: str) -> list[tuple[str, str]]:
        """Edges (type, dependency) of everything that a type needs."""
        edges, todo = [], [name]
        while todo:
            n = todo.pop()
            for d in self.operators[n].depends_on:
                if (n, d) not in edges:
                    edges.append((n, d))
                    todo.append(d)
        return edges

    def _exists(self, path: str) -> bool:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def find(self, run_id: str, name: str) -> str | None:
        for s in self.stores:
            if s["take_only"] is None or name in s["take_only"]:
                path = dataset_path(s["path"], run_id, name, self.key(name))
                if self._exists(path):
                    return path
        return None

    def is_stored(self, run_id: str, name: str) -> bool:
        return self.find(run_id, name) is not None

    def _make(self, run_id: str, name: str, target: bool) -> DataFrame:
        if (path := self.find(run_id, name)) is not None:
            return self.spark.read.parquet(path)
        if name in self.forbid:
            raise DataNotAvailable(f"{name} of run {run_id} is not stored and may not be made")
        o = self.operators[name]
        df = o.compute(*[self._make(run_id, d, False) for d in o.depends_on], run_id=run_id, **self.options_of(name))
        wanted = o.save_when == SaveWhen.ALWAYS or (target and o.save_when == SaveWhen.TARGET)
        return self.save(run_id, name, df) if wanted and self.stores else df

    def save(self, run_id: str, name: str, df: DataFrame, compression: str = "zstd") -> DataFrame:
        for s in self.stores:
            if not s["readonly"] and (s["take_only"] is None or name in s["take_only"]):
                path = dataset_path(s["path"], run_id, name, self.key(name))
                df.write.mode("overwrite").option("compression", compression).parquet(path)
                return self.spark.read.parquet(path)
        return df

    def get_df(
        self, run_id: str, targets: str | Sequence[str], selection: str | Sequence[str] | None = None, time_range: tuple[int, int] | None = None,
        time_selection: str = "fully_contained", keep_columns: Sequence[str] | None = None, on: Sequence[str] | None = None,
    ) -> DataFrame:
        """Targets of one run, joined row by row, cut in time, selected and projected.

        Targets must be of one kind and are joined on its key (or ``on``). Where that does not name the rows of a target, as with equal times,
        the query fails instead of pairing every row with every other.
        """
        names = [targets] if isinstance(targets, str) else list(targets)
        kinds = {self.operators[n].kind for n in names} - {None}
        if len(kinds) > 1:
            raise ValueError(f"types of different kinds cannot be joined: {', '.join(sorted(kinds))}")
        key = list(on or next((self.operators[n].key for n in names if self.operators[n].kind), self.operators[names[0]].key))
        df = self._make(run_id, names[0], True)
        if len(names) > 1:
            df = one_row_a_key(df, key, names[0])
        for n in names[1:]:
            other = self._make(run_id, n, True)
            df = match(df, one_row_a_key(other, key, n).select(*key, *[c for c in other.columns if c not in df.columns]), key)
        if time_range is not None:
            df = select_time(df, *time_range, time_selection)
        if selection:
            df = df.where(rewrite_selection(selection))
        return df.select(*keep_columns) if keep_columns else df

    def make(self, run_id: str, target: str) -> None:
        if not self.is_stored(run_id, target):
            self.save(run_id, target, self._make(run_id, target, False))

    def mini_analysis(self, requires: Sequence[str]):
        """Decorator: a function of its required types' DataFrames, called by name with get_df's arguments."""
        def add(f):
            self.named[f.__name__] = (tuple(requires), f)
            return f

        return add

    def analyse(self, name: str, run_id: str, selection=None, time_range=None, seconds_range=None, run_start: int | None = None, **options):
        requires, f = self.named[name]
        if seconds_range is not None:
            if time_range is not None or run_start is None:
                raise ValueError("give either time_range, or seconds_range with run_start")
            time_range = tuple(run_start + int(s * 1e9) for s in seconds_range)
        return f(self.get_df(run_id, requires, selection, time_range), **options)


def one_row_a_key(df: DataFrame, key: Sequence[str], name: str) -> DataFrame:
    """df; raises for a key with several rows. The rows are dealt by the key, as the join that follows wants them."""
    from pyspark.sql import Window

    parts = F.struct(*key).alias("_on")
    twice = F.count(F.lit(1)).over(Window.partitionBy("_on")) > 1
    lost = F.raise_error(F.lit(f"rows of {name} share a key ({', '.join(key)})")).cast(df.schema[key[0]].dataType)
    return df.select("*", parts).withColumn(key[0], F.when(twice, lost).otherwise(F.col(key[0]))).drop("_on")


def superrun(name: str, parts: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Union of sub-runs made with one configuration."""
    if len({h for _, h in parts.values()}) > 1:
        raise ValueError(f"the sub-runs of {name} differ in configuration")
    frames = [df for df, _ in parts.values()]
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


def rechunk(df: DataFrame, path: str, rows_per_file: int, compression: str = "zstd", order: Sequence[str] = ("time",)) -> None:
    """Rewrites a table in time order with bounded files."""
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).option("compression", compression).parquet(path)


def same_rows(a: DataFrame, b: DataFrame, sums_only: bool = False) -> bool:
    """Equality as multisets, or, for large tables, of counts and column sums."""
    if sums_only:
        numeric = [c for c, t in a.dtypes if t in ("int", "bigint", "double", "float", "smallint")]
        total = lambda d: d.agg(F.count(F.lit(1)), *[F.sum(F.col(c).cast("decimal(38,6)")) for c in numeric]).first()
        return total(a) == total(b)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def json_rows(df: DataFrame, most: int) -> list[str]:
    """At most ``most`` rows as JSON documents."""
    return [r[0] for r in df.limit(most).select(F.to_json(F.struct(*df.columns))).collect()]
