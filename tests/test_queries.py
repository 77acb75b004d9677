"""Every registered query of the interval engine against its DuckDB twin, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from chronofold.plans import registry
from chronofold.session import unpin

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_matches_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(str(v) for v in r) for r in df.select(cols).collect())
    unpin()
    sql = registry.ORACLE_SQL[name]
    want = sorted(tuple(str(v) for v in r) for r in duck.execute(f"select {', '.join(chr(34) + c + chr(34) for c in cols)} from ({sql}) q").fetchall())
    assert got == want


def test_entry(spark):
    assert entry.entry(spark).count() >= 0
    unpin()


def test_every_query_has_sql_or_is_known_not_to():
    assert set(registry.QUERIES) - set(registry.ORACLE_SQL) == {
        "s2_merge_islands", "natural_breaks", "desaturated_records", "som_classification", "veto_recorder", "veto_lone_statistics", "aft_probabilities", "afterpulses", "sample_monitor", "s2_merge_posterior", "enhanced_types",
    }
