"""Live chunk folders: readiness, overlaps, and a stream over folders that grow equals the batch read."""

import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from chronofold.sources import files, live

READERS = {"r0": 2, "r1": 1}
CHUNK, OVERLAP, BREAK, REACH, START = 1000, 300, 40, 50, 10**18 + 3
SCHEMA = pa.schema([("time", pa.int64()), ("length", pa.int32()), ("dt", pa.int32()), ("channel", pa.int32())])
FIELDS = "time long, length int, dt int, channel int"
ARGS = (READERS, CHUNK, OVERLAP, BREAK, REACH, START)


def write(root, folder, rows):
    """rows dealt to the files of all threads."""
    (root / folder).mkdir(parents=True)
    names = [f"{t}_{k}" for t, n in READERS.items() for k in range(n)]
    for k, name in enumerate(names):
        part = rows[k :: len(names)]
        pq.write_table(pa.table({c: [r[i] for r in part] for i, c in enumerate(SCHEMA.names)}, SCHEMA), root / folder / name)


def run(rng, chunks):
    """All folders of a run with their rows."""
    out = {}
    for c in range(chunks):
        start = c * (CHUNK + OVERLAP)
        spans = {"": (start, start + CHUNK), "_post": (start + CHUNK, start + CHUNK + OVERLAP), "_pre": (start - OVERLAP, start)}
        for part, (a, b) in spans.items():
            if (c == 0 and part == "_pre") or (c == chunks - 1 and part == "_post"):
                continue
            same = f"{c - 1:06d}_post"
            out[f"{c:06d}{part}"] = out[same] if part == "_pre" else [(rng.randint(a, b - 1), rng.randint(1, 5), rng.choice([2, 10]), rng.randint(0, 9)) for _ in range(2 if part else 30)]
    return out


def test_ready():
    whole = ["r0_a", "r0_b", "r1_a"]
    folders = {"000000": whole, "000000_post": whole, "000001": whole, "000001_pre": whole, "000001_post": whole[:2], "000002": whole[:1], "other": ["x"]}
    assert live.ready_chunks(folders, READERS) == [0]
    assert live.ready_chunks(folders | {"000001_post": whole}, READERS) == [0, 1]
    ended = folders | {"000002_pre": whole, "THE_END": whole}
    assert live.ready_chunks(ended, READERS) == [0, 1, 2]
    assert live.ready_chunks(ended | {"THE_END": whole[:1]}, READERS) == [0]
    for bad in (["r9_a"], ["r1_a", "r1_b"]):
        with pytest.raises(ValueError, match="unexpected files"):
            live.ready_chunks({"000000": bad}, READERS)


def test_break_equals_the_row_rule(spark):
    rng = random.Random(3)
    for trial in range(12):
        rows = sorted((t := rng.randint(0, 299), t + rng.randint(1, 60), k) for k in range(rng.randint(0, 9)))
        time, end = (np.array([r[i] for r in rows], dtype=np.int64) for i in (0, 1))
        cut, forced = live.quiet_break(time, end, 0, 300, 40, 50)
        if trial < 5:
            df = spark.createDataFrame(rows, "time long, endtime long, channel int")
            kept, other = files.split_overlap(df, 0, 300, 40, 50, 799)
            assert other == cut and kept.where("channel = 799").count() == int(forced)
        assert 0 <= cut <= 300


def test_stream_over_growing_folders_equals_batch(spark, tmp_path):
    rng = random.Random(7)
    made = run(rng, 5)
    (tmp_path / "run").mkdir()
    path, sink, check = str(tmp_path / "run"), str(tmp_path / "out"), str(tmp_path / "check")

    def follow():
        stream = live.stream_live(spark, path, *ARGS, fields=FIELDS, chunks_per_trigger=1)
        query = stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", check).trigger(processingTime="0 seconds").start()
        return query

    query = follow()
    try:
        for c in range(5):
            for name in [n for n in made if n.startswith(f"{c:06d}") and not n.endswith("_post")]:
                write(tmp_path / "run", name, made[name])
            if c == 2:
                query.processAllAvailable()
                query.stop()
                seen = {r.chunk_i for r in spark.read.parquet(sink).select("chunk_i").distinct().collect()}
                assert seen == {0, 1}  # the third chunk waits for its post part
                query = follow()
            if f"{c:06d}_post" in made:
                write(tmp_path / "run", f"{c:06d}_post", made[f"{c:06d}_post"])
            query.processAllAvailable()
        assert {r.chunk_i for r in spark.read.parquet(sink).select("chunk_i").distinct().collect()} == {0, 1, 2, 3}
        unfinished = live.read_live(spark, path, *ARGS, fields=FIELDS)
        assert {r.chunk_i for r in unfinished.select("chunk_i").distinct().collect()} == {0, 1, 2, 3}
        write(tmp_path / "run", "THE_END", [])
        query.processAllAvailable()
    finally:
        query.stop()
    got = spark.read.parquet(sink)
    batch = live.read_live(spark, path, *ARGS, fields=FIELDS)
    rows = lambda df: sorted(tuple(r) for r in df.select("time", "length", "dt", "channel", "chunk_i", "part").collect())
    assert rows(got) == rows(batch)

    # Quiet overlaps: every record is there once, at whole samples since 1970.
    sent = sorted((t + d * (START // d), n, d, ch) for name, part in made.items() if not name.endswith("_pre") for t, n, d, ch in part)
    assert sorted(tuple(r)[:4] for r in batch.select("time", "length", "dt", "channel").collect()) == sent


def test_dense_overlap_gives_dead_time(spark, tmp_path):
    dense = [(t, 5, 10, 1) for t in range(CHUNK, CHUNK + OVERLAP, 20)]
    for name, rows in {"000000": [(1, 2, 10, 0)], "000000_post": dense, "000001": [], "000001_pre": dense, "000001_post": []}.items():
        write(tmp_path, name, rows)
    got = live.read_live(spark, str(tmp_path), READERS, CHUNK, OVERLAP, BREAK, REACH, fields=FIELDS).collect()
    cut = CHUNK + OVERLAP - BREAK
    assert sorted((r.time, r.length, r.dt, r.part) for r in got if r.channel == 799) == [(cut - REACH, REACH // 10, 10, "post"), (cut, BREAK // 10, 10, "pre")]
    assert all(r.time + r.length * r.dt <= cut for r in got if r.part == "post") and [r.channel for r in got if r.part == "pre"] == [799]


def test_rows_outside_their_part_raise(spark, tmp_path):
    write(tmp_path, "000000", [(CHUNK, 1, 2, 0)] * 3)
    write(tmp_path, "000000_post", [])
    with pytest.raises(Exception, match="should hold data"):
        live.read_live(spark, str(tmp_path), *ARGS, fields=FIELDS).collect()
    with pytest.raises(ValueError, match="longer than a safe break"):
        live.ChunkBatchReader({"path": "x", "readers": "{}", "chunk_ns": "10", "overlap_ns": "5", "safe_break_ns": "6", "reach_ns": "1"}, None)
