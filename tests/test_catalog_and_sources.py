"""Catalog, remote store, paged values, URL checks, chunk readiness, late rows and clock edges."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from chronofold.operators import peaklets
from chronofold.plans import lint
from chronofold.plans.engine import DataNotAvailable
from chronofold.sources import catalog, paged

LINEAGE = {"peaks": ["Peaks", "1", {"gap": 3, "seed": 1}], "hits": ["Hits", "2", {}]}


def serve(parameter, start, end, limit):
    """A service with a value every 10 ns, for the test below."""
    first = -(-start // 10) * 10
    return [(t, t / 10 if parameter == "a" else None) for t in range(first, end, 10)][:limit]


def test_catalog_finds_whole_datasets_only(spark, tmp_path):
    c = catalog.Catalog(spark, str(tmp_path / "store"))
    with pytest.raises(DataNotAvailable):
        c.find("000007", "peaks", LINEAGE)
    first = c.save(spark.range(5), "000007", "peaks", LINEAGE)
    c.save(spark.range(3), "000008", "peaks", LINEAGE)
    assert c.find("000007", "peaks", LINEAGE) == first and spark.read.parquet(first).count() == 5
    assert sorted(r.run_id for r in c.runs_with("peaks").collect()) == ["000007", "000008"]
    other = {**LINEAGE, "peaks": ["Peaks", "1", {"gap": 3, "seed": 2}]}
    with pytest.raises(DataNotAvailable):
        c.find("000007", "peaks", other)
    with pytest.warns(UserWarning, match="is taken from"):
        assert c.find("000007", "peaks", other, fuzzy_options=["seed"]) == first
    with pytest.warns(UserWarning, match="is taken from"):
        assert c.find("000007", "peaks", {**LINEAGE, "hits": ["Hits", "3", {}]}, fuzzy_types=["hits"]) == first
    keys = spark.createDataFrame([("000007", "peaks", catalog.config_hash(LINEAGE)), ("000007", "hits", "x")], "run_id string, data_type string, lineage_hash string")
    assert {r.data_type: r.location for r in c.find_several(keys).collect()} == {"peaks": first, "hits": None}
    again = c.save(spark.range(9), "000007", "peaks", LINEAGE)
    assert again == first and c.manifest().count() == 2
    os.remove(next(p for p in (tmp_path / "store").rglob("*.parquet") if "000007" in str(p)))
    with pytest.raises(DataNotAvailable):
        c.find("000007", "peaks", LINEAGE)
    with pytest.raises(PermissionError):
        catalog.Catalog(spark, str(tmp_path / "store"), readonly=True).save(spark.range(1), "1", "peaks", LINEAGE)


def test_remote_store_copies_light_types(spark, tmp_path):
    c = catalog.Catalog(spark, str(tmp_path / "far"))
    c.save(spark.range(5), "000007", "peaks", LINEAGE)
    c.save(spark.range(5), "000007", "raw_records", LINEAGE)
    store = catalog.RemoteStore(c, str(tmp_path / "near"))
    assert store.read("000007", "peaks", LINEAGE).count() == 5 and len(os.listdir(tmp_path / "near")) == 1
    with pytest.raises(DataNotAvailable, match="too large"):
        store.read("000007", "raw_records", LINEAGE)
    assert catalog.RemoteStore(c, str(tmp_path / "near"), allow_heavy=True).read("000007", "raw_records", LINEAGE).count() == 5
    store.release("000007", "peaks", LINEAGE)
    assert len(os.listdir(tmp_path / "near")) == 1
    shutil.rmtree(tmp_path / "near")


def test_paged_values_come_whole(spark):
    name = f"tests.{__name__.rpartition('.')[2]}:serve"
    got = paged.read_values(spark, name, ["a", "b"], 5, 1003, page=7).collect()
    assert sorted((r.parameter, r.time) for r in got) == sorted((p, t) for p in "ab" for t in range(10, 1003, 10))
    assert {r.value for r in got if r.parameter == "b"} == {None} and {r.value for r in got if r.time == 50 and r.parameter == "a"} == {5.0}
    spans = paged.PagedReader({"client": name, "parameters": '["a"]', "start": "0", "end": str(2 * paged.YEAR + 5)}).partitions()
    assert [(s.start, s.end) for s in spans] == [(0, paged.YEAR), (paged.YEAR, 2 * paged.YEAR), (2 * paged.YEAR, 2 * paged.YEAR + 5)]
    for bad in ((5, 5, None), (0, 10, 2 * paged.OLDEST)):
        with pytest.raises(ValueError):
            paged.read_values(spark, name, ["a"], *bad)


def test_url_checks():
    assert lint.lint("take://corrections://gains?version=v1&attr=value") == [] and lint.lint("no url") == [] and lint.lint(3) == []
    assert len(lint.lint("objects-to-dict://corrections://gains?key_attr=a")) == 5
    assert lint.lint("cmt://x") == ["the protocol is removed"]
    assert len(lint.lint("corrections://xyz_maps?version=v1&attr=x")) == 2 and lint.lint("corrections://xyz_maps?version=v1&attr=map") == []
    assert lint.lint_config({"a": "file://posrec_models_x", "b": 3, "c": "tf://posrec_models_x"}) == {"a": ["a position model needs tf:// or jax://"]}


def test_clock_edges_fall_back_to_starts(spark):
    quiet, step = [100] * 50, [100] * 45 + [20] * 3 + [100] * 2
    rows = [("0", 0, 1000, 10, 0, step), ("0", 1, 5000, 10, 0, quiet), ("1", 0, 1000, 10, 0, quiet), ("1", 1, 2000, 10, 1, quiet)]
    r = spark.createDataFrame(rows, "run_id string, hit_id long, time long, dt int, record_i int, data array<int>")
    got = sorted((x.run_id, x.hit_id, x.time) for x in peaklets.clock_edges(r, 50, 7).collect())
    assert got == [("0", 0, 1450), ("1", 0, 1007)]
    assert peaklets.clock_edges(r.where(F.lit(False)), 50).count() == 0
