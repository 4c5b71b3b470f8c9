"""Trailing frames from two merged halves: equal to plain loops, with one series spread over many ranges."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from scarp.operators import failure as fl
from scarp.operators import metrics as mt
from scarp.operators import sliding as sl

T0 = datetime(2024, 1, 1)


def some(rnd, n, burst):
    rows = []
    for k in range(n):
        hot = rnd.random() < burst
        key = "hot" if hot else rnd.choice(["a", "b", None])
        at = 30_000_000 + rnd.randrange(400_000) if hot else rnd.randrange(0, 120_000_000)
        if rnd.random() < 0.2:
            at = at // 5_000_000 * 5_000_000                  # ties, and times on cell borders
        rows.append((k, key, T0 + timedelta(microseconds=at), rnd.choice([None, rnd.uniform(-1, 1), rnd.uniform(-1, 1)])))
    return rows + [(n, "a", None, 1.0)]


@pytest.mark.parametrize("partitions", [1, 4, 13])
def test_frames_equal_a_plain_loop(spark, partitions):
    rnd = random.Random(partitions)
    rows = some(rnd, 600, 0.4)
    df = spark.createDataFrame(rows, "id long, k string, t timestamp_ntz, v double")
    v = F.col("v")
    got = sl.frame_aggregate(df, ["k"], "10 seconds", {"n": lambda x: F.lit(1.0), "s": lambda x: v, "sx": lambda x: x},
                             {"first_v": v, "first_t": F.col("t")}, "t", "id", partitions).collect()
    assert len(got) == len(rows)
    by_key = {}
    for r in rows:
        by_key.setdefault(r[1], []).append(r)
    for r in got:
        if r.t is None:
            assert r.n is None and r.first_t is None
            continue
        inside = sorted((o for o in by_key[r.k] if o[2] is not None and r.t - timedelta(seconds=10) <= o[2] <= r.t), key=lambda o: (o[2], o[0]))
        origin = T0 + (r.t - T0) // timedelta(seconds=10) * timedelta(seconds=10)
        assert r.n == len(inside)
        assert abs(r.s - sum(o[3] or 0.0 for o in inside)) < 1e-9
        assert abs(r.sx - sum((o[2] - origin).total_seconds() for o in inside)) < 1e-6
        assert (r.first_v, r.first_t) == (inside[0][3], inside[0][2])


def test_methods_agree(spark):
    rnd = random.Random(9)
    rows = [(k, "c", T0 + timedelta(microseconds=rnd.randrange(200_000_000)), rnd.uniform(1, 9)) for k in range(400)]
    df = spark.createDataFrame(rows, "sample_id long, cluster_id string, ts timestamp_ntz, value double")
    trends = {m: {r.sample_id: (r.slope, r.ttf_seconds) for r in fl.time_to_failure(df, time_col="ts", value_col="value", method=m).collect()}
              for m in ("frame", "blocks")}
    assert trends["frame"].keys() == trends["blocks"].keys()
    for k, (slope, ttf) in trends["frame"].items():
        other, other_ttf = trends["blocks"][k]
        assert (slope is None) == (other is None) and (slope is None or abs(slope - other) < 1e-9)
        assert (ttf is None) == (other_ttf is None) and (ttf is None or abs(ttf - other_ttf) < 1e-6 * max(1, abs(ttf)))
    labelled = df.withColumns({"metric": F.lit("m"), "instance": F.lit(None).cast("string"), "mode": F.lit("x")})
    rates = {m: {r.sample_id: r.rate for r in mt.counter_rate(labelled, method=m).collect()} for m in ("prefix", "blocks")}
    assert rates["prefix"].keys() == rates["blocks"].keys()
    for k, rate in rates["prefix"].items():
        assert (rate is None) == (rates["blocks"][k] is None) and (rate is None or abs(rate - rates["blocks"][k]) < 1e-9)


def test_a_burst_is_many_tasks(spark, monkeypatch):
    """A third of all rows in one cell of one series: no piece above twice the median."""
    kept = []
    real = sl.materialize
    monkeypatch.setattr(sl, "materialize", lambda df: kept.append(real(df)) or kept[-1])
    df = spark.range(60_000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 50)).alias("k"),
                                    F.timestamp_micros(F.when(F.col("id") % 3 == 0, F.col("id") + 30_000_000).otherwise(F.col("id") * 2000)).alias("t"))
    n = sl.frame_aggregate(df, ["k"], "60 seconds", {"n": lambda x: F.lit(1.0)}, time_col="t", partitions=24)
    assert n.where("k = 'hot'").agg(F.max("n")).first()[0] == 20_000
    sizes = sorted(r["count"] for r in kept[1].groupBy("_part").count().collect())
    assert len(sizes) == 24 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    pieces = kept[1].where("_sk.k = 'hot' AND _row = 1").select("_part").distinct().count()
    assert pieces >= 3                                        # of about four: a sixth of the rows, its marks are another cell
