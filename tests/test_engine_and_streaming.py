"""Lineage, configuration URLs, live chunks, and batch against stream."""

import json

import pytest
from pyspark.sql import functions as F

from chronofold.plans import resolver
from chronofold.plans.engine import DataNotAvailable, Engine, rewrite_selection, same_rows, superrun
from chronofold.sources import files
from chronofold.streaming import processors as ps


def engine(spark, root, **config):
    e = Engine(spark, config, [str(root)])

    @e.operator("raw", version="1", options={"n": 5})
    def raw(run_id, n):
        return spark.range(n).select(F.lit(run_id).alias("run_id"), F.col("id").alias("time"), (F.col("id") + 1).alias("endtime"))

    @e.operator("area", ["raw"], options={"gain": 2})
    def area(raw, run_id, gain):
        return raw.withColumn("area", F.col("time") * gain)

    return e


def test_lineage_decides_what_is_stored(spark, tmp_path):
    e = engine(spark, tmp_path)
    assert not e.is_stored("000001", "area")
    assert e.get_df("000001", "area", "area>2 & area<8").count() == 2
    assert e.is_stored("000001", "area") and not e.is_stored("000001", "raw")
    other = engine(spark, tmp_path, gain=3)
    assert other.key("area") != e.key("area") and other.key("raw") == e.key("raw")
    assert not other.is_stored("000001", "area")
    other.forbid.add("area")
    with pytest.raises(DataNotAvailable):
        other.get_df("000001", "area")
    assert e.dependency_tree("area") == [("area", "raw")]


def test_targets_join_row_by_row(spark, tmp_path):
    """Rows of equal time are joined by their kind's key; where nothing names them, the query fails."""
    e = Engine(spark, {}, [str(tmp_path)])
    rows = [("000001", 5, 6, 1), ("000001", 5, 7, 2), ("000001", 9, 10, 3)]

    @e.operator("peaks", kind="peaks", key=("run_id", "peak_id"))
    def peaks(run_id):
        return spark.createDataFrame(rows, "run_id string, time long, endtime long, peak_id long")

    @e.operator("sizes", ["peaks"], kind="peaks", key=("run_id", "peak_id"))
    def sizes(peaks, run_id):
        return peaks.select("run_id", "time", "peak_id", (F.col("peak_id") * 10).alias("size"))

    @e.operator("events", kind="events")
    def events(run_id):
        return spark.createDataFrame([("000001", 5, 10)], "run_id string, time long, endtime long")

    assert sorted((r.peak_id, r.endtime, r["size"]) for r in e.get_df("000001", ["peaks", "sizes"]).collect()) == [(1, 6, 10), (2, 7, 20), (3, 10, 30)]
    with pytest.raises(Exception, match="share a key"):
        e.get_df("000001", ["peaks", "sizes"], on=("run_id", "time")).collect()
    with pytest.raises(ValueError, match="different kinds"):
        e.get_df("000001", ["peaks", "events"])


def test_named_queries(spark, tmp_path):
    e = engine(spark, tmp_path)

    @e.mini_analysis(["raw", "area"])
    def total(df, factor=1):
        return df.agg(F.sum("area")).first()[0] * factor

    assert e.analyse("total", "000001") == 20
    assert e.analyse("total", "000001", seconds_range=(0, 3e-9), run_start=0, factor=2) == 12


def test_selections_and_superruns(spark):
    assert rewrite_selection(["a == 1", "b>2 | ~c"]).replace("  ", " ").replace("  ", " ") == "(a = 1) AND (b>2 OR NOT c)"
    a = spark.range(3)
    assert superrun("_x", {"1": (a, "h"), "2": (a, "h")}).count() == 6
    with pytest.raises(ValueError, match="differ"):
        superrun("_x", {"1": (a, "h"), "2": (a, "g")})
    assert same_rows(a, spark.range(3)) and not same_rows(a, spark.range(4)) and same_rows(a, spark.range(3), True)


def test_config_urls(tmp_path):
    assert resolver.resolve('take://json://{"a":{"aa":0,"ab":1},"b":{"ba":2,"bb":3}}?take=b&take=ba') == 2
    assert resolver.resolve("format://run_{run_id}?run_id=7") == "run_7"
    assert resolver.resolve("plain") == "plain"
    (tmp_path / "c.json").write_text(json.dumps([{"time": 0, "ab": 10, "cd": 11}, {"time": 10, "ab": 30, "cd": 31}]))
    assert resolver.resolve(f"itp_dict://file://{tmp_path}/c.json?fmt=json&time=5&itp_keys=ab,cd") == {"ab": 20, "cd": 21}
    with pytest.raises(ValueError, match="outside"):
        resolver.resolve(f"itp_dict://file://{tmp_path}/c.json?fmt=json&time=50&itp_keys=ab")
    assert resolver.run_document("a.b.1", run_doc={"a": {"b": [4, 5]}}) == 5
    with pytest.raises(ValueError, match="no such protocol"):
        resolver.resolve("nope://x")


def test_live_chunks(spark, tmp_path):
    for name in ("000000", "000000_post", "000001_pre"):
        files.dummy_records(spark, 4).write.parquet(str(tmp_path / name))
    got = files.read_chunks(spark, str(tmp_path), "run_id string, time long, endtime long, channel int")
    assert sorted((r.chunk_i, r.part, r["count"]) for r in got.groupBy("chunk_i", "part").count().collect()) == [(0, "central", 4), (0, "post", 4), (1, "pre", 4)]
    with pytest.raises(Exception, match="outside its chunk"):
        files.validate_times(got, 0, 2000).collect()


def test_channel_remap(spark):
    df = spark.createDataFrame([(1, [10, 11, 12])], "channel int, apc array<int>")
    r = files.remap_channels(df, {1: 2, 2: 1}, array="apc").first()
    assert (r.channel, list(r.apc)) == (2, [10, 12, 11])


@pytest.fixture(scope="module")
def stream_input(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stream"))
    rows = [("0", i, i * 10**9 * 60, i % 3, i * 7 % 50, i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, "run_id string, hit_id long, time long, channel long, area long, type int")
    for k in range(4):
        df.where((F.col("hit_id") >= 50 * k) & (F.col("hit_id") < 50 * k + 50)).coalesce(1).write.mode("append").parquet(path)
    return path, df


def run(spark, df, name, tmp_path):
    q = ps.start_available(df, name, str(tmp_path / name))
    q.awaitTermination(120)
    return spark.table(name)


def test_stream_equals_batch(spark, stream_input, tmp_path):
    path, df = stream_input
    stream = spark.readStream.schema(df.schema).parquet(path)
    got = run(spark, ps.tumbling_monitor(ps.with_timestamp(stream)), "tumbling", tmp_path)
    batch = ps.with_timestamp(df).groupBy(F.window("ts", "1 hour"), "type").agg(F.count(F.lit(1)).alias("n"), F.sum("area").alias("area"))
    want = {(r.type, r.n, r.area) for r in batch.collect()}
    assert {(r.type, r.n, r.area) for r in got.collect()} <= want and got.count() >= len(want) - 2
