"""Chunk folders of a running acquisition as one Spark data source, batch and stream.

A chunk NNNNNN has a central folder and, before and after it, the overlaps NNNNNN_pre and NNNNNN_post, each with one parquet file per
reader thread and output, named <thread>_<anything>. The folder THE_END, filled by every thread, says that the run is over.

The stream's offset is the last chunk of an unbroken row of ready ones; a batch read takes all that are ready, so an unfinished run can be
read up to there. Each part of a chunk is a partition: its files are read, sorted by time, checked against the part's time span, overlaps are cut at a
quiet gap, and times become nanoseconds since 1970, shifted by whole samples. Folders are reached through pyarrow's file systems, so they may be local or
in any store that those know.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from chronofold.sources.files import RAW_RECORDS

THE_END = "THE_END"
_PART = re.compile(r"(\d{6})(?:_(pre|post))?$")


def part_is_whole(names: Iterable[str], readers: Mapping[str, int], place: str) -> bool:
    """Whether a folder has a file of every thread's every output; files of an unknown thread, or too many of one, raise."""
    counts = Counter(n.rpartition("_")[0] for n in names)
    for thread, n in counts.items():
        if n > readers.get(thread, 0):
            raise ValueError(f"unexpected files of {thread!r} in {place}")
    return sum(counts.values()) >= sum(readers.values())


def ready_chunks(folders: Mapping[str, Iterable[str]], readers: Mapping[str, int]) -> list[int]:
    """Chunks that can be read, from the names of the files in each folder.

    A part of a chunk is whole with a file of every thread's every output, or once the run has ended. A chunk needs itself, its post part
    and, unless it is the first, its pre part; after the end the last one needs no post part.
    """
    ended = THE_END in folders and part_is_whole(folders[THE_END], readers, THE_END)
    whole: dict[tuple[int, str], bool] = {}
    for name, files in folders.items():
        if found := _PART.match(name):
            whole[int(found[1]), found[2] or "central"] = part_is_whole(files, readers, name) or ended
    out = []
    for chunk in sorted(c for c, part in whole if part == "central"):
        has = lambda part: whole.get((chunk, part), False)  # noqa: B023, E731
        last = ended and has("pre") and (chunk + 1, "central") not in whole
        if has("central") and ((has("pre") and has("post")) or (chunk == 0 and has("post")) or last):
            out.append(chunk)
    return out


def quiet_break(time: np.ndarray, endtime: np.ndarray, start: int, end: int, min_gap: int, reach: int) -> tuple[int, bool]:
    """(break, forced) in the overlap [start, end): before its end if that is quiet, else the first gap of min_gap that no row of the last chunk can reach
    into, else min_gap before the end by force."""
    if not len(time) or endtime.max() + min_gap < end:
        return end - min_gap, False
    until = np.maximum.accumulate(endtime)[:-1]
    quiet = np.flatnonzero((time[1:] - until >= min_gap) & (until >= start + reach))
    return (int(until[quiet[0]]), False) if len(quiet) else (end - min_gap, True)


class Part(InputPartition):
    def __init__(self, chunk: int, part: str):
        self.chunk, self.part = chunk, part


class _Chunks:
    """What batch and stream share: the listing of the folder and the reading of one part."""

    def __init__(self, options: Mapping[str, str], schema: StructType):
        self.root = options["path"]
        self.readers = {k: int(v) for k, v in json.loads(options["readers"]).items()}
        number = lambda name, default=None: int(options.get(name, default))
        self.length, self.overlap, self.t0 = number("chunk_ns"), number("overlap_ns"), number("run_start_ns", 0)
        self.min_gap, self.reach, self.dt_max = number("safe_break_ns"), number("reach_ns"), number("max_dt_ns", 10)
        self.dead_channel, self.per_trigger = number("dead_channel", 799), number("chunks_per_trigger", 0)
        if self.min_gap > min(self.length, self.overlap):
            raise ValueError("chunks and overlaps must be longer than a safe break")
        self.schema = to_arrow_schema(schema)

    def _store(self):
        return fs.FileSystem.from_uri(self.root) if "://" in self.root else (fs.LocalFileSystem(), self.root)

    def listing(self) -> dict[str, list[str]]:
        store, path = self._store()
        out: dict[str, list[str]] = {}
        for info in store.get_file_info(fs.FileSelector(path, recursive=True)):
            names = info.path[len(path.rstrip("/")) + 1 :].split("/")
            if info.type == fs.FileType.Directory:
                out.setdefault(names[0], [])
            elif len(names) == 2 and not names[1].startswith((".", "_")):
                out.setdefault(names[0], []).append(names[1])
        return out

    def parts(self, chunks: Iterable[int]) -> list[Part]:
        there = self.listing()
        folders = {"central": "", "pre": "_pre", "post": "_post"}
        return [Part(c, part) for c in chunks for part, end in folders.items() if f"{c:06d}{end}" in there and not (c == 0 and part == "pre")]

    def span(self, chunk: int, part: str) -> tuple[int, int]:
        start = chunk * (self.length + self.overlap)
        return {"central": (start, start + self.length), "pre": (start - self.overlap, start), "post": (start + self.length, start + self.length + self.overlap)}[part]

    def read_part(self, chunk: int, part: str) -> Iterator[pa.RecordBatch]:
        store, path = self._store()
        folder = f"{path.rstrip('/')}/{chunk:06d}{'' if part == 'central' else '_' + part}"
        files = sorted(i.path for i in store.get_file_info(fs.FileSelector(folder)) if i.type == fs.FileType.File and not i.base_name.startswith((".", "_")))
        fields = [f for f in self.schema if f.name not in ("chunk_i", "part")]
        tables = [pq.read_table(f, columns=[x.name for x in fields], filesystem=store).cast(pa.schema(fields)) for f in files]
        rows = pa.concat_tables(tables) if tables else pa.schema(fields).empty_table()
        rows = rows.take(np.argsort(rows.column("time").to_numpy(), kind="stable"))
        time, dt = rows.column("time").to_numpy(), rows.column("dt").to_numpy().astype(np.int64)
        end = time + rows.column("length").to_numpy().astype(np.int64) * dt
        first, last = self.span(chunk, part)
        if len(time) and (time[0] < first or time[-1] >= last):
            raise ValueError(f"{folder} should hold data that starts in [{first}, {last}), but starts range from {time[0]} to {time[-1]}")
        keep, dead = np.ones(len(time), dtype=bool), None
        if part != "central":
            cut, forced = quiet_break(time, end, first, last, self.min_gap, self.reach)
            keep = end <= cut if part == "post" else (time >= cut) & (not forced)
            dead = ((cut - self.reach, cut) if part == "post" else (cut, last)) if forced else None
        rows, time, dt = rows.filter(pa.array(keep)), time[keep], dt[keep]
        if dead:
            mark = {"time": dead[0], "length": (dead[1] - dead[0]) // self.dt_max, "dt": self.dt_max, "channel": self.dead_channel}
            extra = pa.table({f.name: pa.array([mark.get(f.name)], f.type) for f in fields}, pa.schema(fields))
            rows = pa.concat_tables([rows, extra])
            order = np.argsort(np.append(time, dead[0]), kind="stable")
            rows, time, dt = rows.take(order), np.append(time, dead[0])[order], np.append(dt, self.dt_max)[order]
        at = rows.schema.get_field_index("time")
        rows = rows.set_column(at, rows.schema.field(at), pa.array(time + dt * (self.t0 // np.maximum(dt, 1)), pa.int64()))
        for name, value in (("chunk_i", chunk), ("part", part)):
            if name in self.schema.names:
                rows = rows.append_column(self.schema.field(name), pa.array([value] * rows.num_rows, self.schema.field(name).type))
        yield from rows.select(self.schema.names).to_batches(max_chunksize=10_000)


class ChunkBatchReader(_Chunks, DataSourceReader):
    def partitions(self) -> Sequence[InputPartition]:
        return self.parts(ready_chunks(self.listing(), self.readers))

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if isinstance(partition, Part):
            yield from self.read_part(partition.chunk, partition.part)


class ChunkStreamReader(_Chunks, DataSourceStreamReader):
    def __init__(self, options: Mapping[str, str], schema: StructType):
        super().__init__(options, schema)
        self.served = None

    def initialOffset(self) -> dict:  # noqa: N802
        return {"chunk": -1}

    def latestOffset(self) -> dict:  # noqa: N802
        """The last chunk of the unbroken row of ready ones that begins with the first folder, or behind what has been served."""
        ready = set(ready_chunks(self.listing(), self.readers))
        at = min(ready, default=0) - 1 if self.served is None else self.served
        most = at + self.per_trigger if self.per_trigger else None
        while at + 1 in ready and (most is None or at < most):
            at += 1
        return {"chunk": at}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        self.served = max(end["chunk"], -1 if self.served is None else self.served)
        return self.parts(range(start["chunk"] + 1, end["chunk"] + 1))

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if isinstance(partition, Part):
            yield from self.read_part(partition.chunk, partition.part)

    def commit(self, end: dict) -> None:
        pass


class LiveChunks(DataSource):
    @classmethod
    def name(cls) -> str:
        return "live_chunks"

    def schema(self) -> str:
        return f"{self.options.get('fields', RAW_RECORDS)}, chunk_i int, part string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return ChunkBatchReader(self.options, schema)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:  # noqa: N802
        return ChunkStreamReader(self.options, schema)


def _options(path: str, readers: Mapping[str, int], chunk: int, overlap: int, safe_break: int, reach: int, run_start: int, more: Mapping[str, object]) -> dict[str, str]:
    known = {"path": path, "readers": json.dumps(dict(readers)), "chunk_ns": chunk, "overlap_ns": overlap, "safe_break_ns": safe_break, "reach_ns": reach, "run_start_ns": run_start}
    return {k: str(v) for k, v in (known | dict(more)).items()}


def read_live(spark: SparkSession, path: str, readers: Mapping[str, int], chunk: int, overlap: int, safe_break: int, reach: int, run_start: int = 0, **more) -> DataFrame:
    """The chunks that are ready now, of a run that may go on. more: fields, max_dt_ns, dead_channel."""
    spark.dataSource.register(LiveChunks)
    return spark.read.format("live_chunks").options(**_options(path, readers, chunk, overlap, safe_break, reach, run_start, more)).load()


def stream_live(spark: SparkSession, path: str, readers: Mapping[str, int], chunk: int, overlap: int, safe_break: int, reach: int, run_start: int = 0, **more) -> DataFrame:
    """The same as a stream that follows the run. more: also chunks_per_trigger, the most chunks of one micro-batch (back-pressure)."""
    spark.dataSource.register(LiveChunks)
    return spark.readStream.format("live_chunks").options(**_options(path, readers, chunk, overlap, safe_break, reach, run_start, more)).load()
