"""Streams that come late and out of order give what the batch operators give."""

import random

import pytest
from pyspark.sql import functions as F

from chronofold.operators import neighbourhood as nb
from chronofold.streaming import release as rl

SECOND = 10**9
SCHEMA = "run_id string, hit_id long, time long, endtime long, center_time long, type int, area double, x double, y double"


@pytest.fixture(scope="module")
def peaks():
    rng = random.Random(5)
    rows = []
    for i in range(400):
        t = 50 * SECOND + rng.randint(0, 100 * SECOND)
        length = rng.choice([10, 10**6, 3 * SECOND])
        place = (rng.uniform(-50, 50), rng.uniform(-50, 50)) if rng.random() < 0.9 else (None, None)
        rows.append((rng.choice(["0", "1", None]), i, t, t + length, t + length // 2, rng.choice([1, 2]), rng.uniform(1, 900), *place))
    return sorted(rows, key=lambda r: r[2])


def scores(rows, by):
    one = nb.proximity(rows, 4 * SECOND, by=by)
    two = nb.shadow(rows, 4 * SECOND, 300.0, 2, by=by).select(*by, "hit_id", "shadow", "dt", "nearest_dt")
    three = nb.competing(rows, 2 * SECOND, by=by)
    from chronofold.operators.ordered import match

    return match(match(one, two, [*by, "hit_id"]), three, [*by, "hit_id"])


def test_late_and_shuffled_batches_give_the_batch_result(spark, peaks, tmp_path):
    """Files hold rows up to 8 s out of order; three rows come after 20 s and more and are late."""
    rng = random.Random(2)
    late = [peaks[k] for k in (20, 90, 200)]
    order = sorted((r for r in peaks if r not in late), key=lambda r: r[2] + rng.randint(0, 8 * SECOND))
    files = [order[k : k + 57] for k in range(0, len(order), 57)]
    files[-1] = files[-1] + late
    files.append([("end", 10**6, 10**13, 10**13 + 1, 10**13, 1, 1.0, 0.0, 0.0)])
    for k, part in enumerate(files):
        rng.shuffle(part)
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        # The stream reads its files in the order of their age.
        newest = max((tmp_path / "in").glob("*.parquet"), key=lambda p: p.stat().st_mtime)
        import os

        os.utime(newest, (10**9 + k, 10**9 + k))
    rl.release_config(spark)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    released = rl.release(stream, 10 * SECOND, 4 * SECOND, 2 * SECOND, "9 seconds")
    query = rl.score_released(released, scores, f"{tmp_path}/out", f"{tmp_path}/check")
    query.awaitTermination(300)
    assert query.exception() is None

    kept = spark.createDataFrame([r for r in peaks if r not in late], SCHEMA)
    flat = lambda df: sorted((r.hit_id, r.run_id or "", round(r.proximity_score, 9), round(r.shadow, 12), r.dt, r.nearest_dt, r.n_competing_left, r.n_competing) for r in df.collect())
    got = flat(spark.read.parquet(f"{tmp_path}/out/scores").where("hit_id < 1000000"))
    assert got == flat(scores(kept, ("run_id",))) and len(got) == 397
    assert sorted(r.hit_id for r in spark.read.parquet(f"{tmp_path}/out/late").collect()) == sorted(r[1] for r in late)
    # Buckets went out while the stream ran, and the state went with them.
    assert spark.read.parquet(f"{tmp_path}/out/scores").select("batch").distinct().count() > 3
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(held) < len(peaks) and held[-1] < 10
    dead = rl.dead_spans(spark.read.parquet(f"{tmp_path}/out/late"), 799).collect()
    assert {r.channel for r in dead} == {799} and len(dead) == 3


def test_release_keeps_what_other_buckets_see(spark):
    rows = spark.createDataFrame([("0", 1, 95, 250, 120)], "run_id string, hit_id long, time long, endtime long, center_time long")
    width, back, ahead = 100, 30, 10
    floor = lambda c: F.call_function("div", c - F.pmod(c, F.lit(width)), F.lit(width))
    got = rows.select(F.sequence(F.least(floor(F.col("time") - ahead), floor(F.col("center_time"))), floor(F.col("endtime") + back)).alias("b")).first().b
    assert list(got) == [0, 1, 2]
