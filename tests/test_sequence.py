"""Bucketed sequence operators against plain per-series loops (brute force).

Small bucket widths force many buckets, so carries across buckets, the
affine tree (more than 64 buckets) and block splits (products beyond e^300)
are all exercised. One series holds most rows (a hot key).
"""

import random
from datetime import datetime, timedelta

import pytest

from pyspark.sql import functions as F

from scarp.operators import sequence as sq
from scarp.operators import motion as mo

BASE = datetime(2024, 1, 1)


def _rows(n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    t = {"hot": 0.0, "a": 0.0, "b": 0.0}
    for i in range(n):
        s = "hot" if rnd.random() < 0.7 else rnd.choice(["a", "b"])
        t[s] += rnd.choice([0.0, 0.05, 0.2, 0.7, 2.5])
        v = None if rnd.random() < 0.2 else round(rnd.uniform(-5, 5), 3)
        a = rnd.choice([0.5, 0.9, 0.95, 1.0, 0.01])
        rows.append((i, s, BASE + timedelta(seconds=t[s]), v, a))
    return rows


@pytest.fixture(scope="module")
def seq(spark):
    return spark.createDataFrame(_rows(), "id long, s string, t timestamp_ntz, v double, a double")


def _series(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        out.setdefault(r[1], []).append(r)
    return out


def test_with_previous(seq):
    got = {r.id: r.prev_v for r in sq.with_previous(seq, ["s"], ["v"], "t", "id", width="1 second").collect()}
    for rows in _series(_rows()).values():
        prev = None
        for i, r in enumerate(rows):
            assert got[r[0]] == (rows[i - 1][3] if i else None)


def test_forward_fill(seq):
    got = {r.id: r.v_filled for r in sq.forward_fill(seq, ["s"], ["v"], "t", "id", width="2 seconds").collect()}
    for rows in _series(_rows()).values():
        last = None
        for r in rows:
            last = r[3] if r[3] is not None else last
            assert got[r[0]] == last


def test_running_sum(seq):
    got = {r.id: r.c for r in sq.running_sum(seq, ["s"], "v", "c", "t", "id", width="1 second").collect()}
    for rows in _series(_rows()).values():
        acc = 0.0
        for r in rows:
            acc += r[3] or 0.0
            assert abs(got[r[0]] - acc) < 1e-9


def test_linear_scan_matches_loop(seq):
    out = sq.linear_scan(seq, ["s"], F.col("a"), [F.coalesce("v", F.lit(0.0)), F.lit(1.0)], ["y", "z"],
                         "t", "id", width="1 second", prev_outs=["y_prev", "z_prev"])
    got = {r.id: r for r in out.collect()}
    for rows in _series(_rows()).values():
        y = z = 0.0
        for r in rows:
            yp, zp = y, z
            y = r[4] * y + (r[3] or 0.0)
            z = r[4] * z + 1.0
            g = got[r[0]]
            assert abs(g.y - y) <= 1e-9 * max(1.0, abs(y)), (r, g.y, y)
            assert abs(g.z - z) <= 1e-9 * max(1.0, abs(z))
            assert abs(g.y_prev - yp) <= 1e-9 * max(1.0, abs(yp))


def test_linear_scan_long_decay_block_split(spark):
    # 4000 rows with a = 0.5: the running product leaves double range after
    # ~1000 rows, so the scan must split blocks and carry between them.
    rows = [(i, "k", BASE + timedelta(milliseconds=10 * i), float(i % 7) - 3.0) for i in range(4000)]
    df = spark.createDataFrame(rows, "id long, s string, t timestamp_ntz, x double")
    got = {r.id: r.y for r in sq.linear_scan(df, ["s"], F.lit(0.5), [F.col("x")], ["y"], "t", "id",
                                              width="7 seconds").collect()}
    y = 0.0
    for i, _, _, x in rows:
        y = 0.5 * y + x
        assert abs(got[i] - y) < 1e-9


def test_integrate_damped_against_loop(spark):
    rnd = random.Random(3)
    rows, t = [], 0.0
    for i in range(600):
        t += rnd.choice([0.01, 0.1, 0.3])
        rows.append((i, "imu_1", BASE + timedelta(seconds=t), rnd.uniform(-1, 1), rnd.uniform(-1, 1),
                     -9.81 + rnd.uniform(-0.2, 0.2)))
    df = spark.createDataFrame(rows, "event_id long, sensor_id string, event_time timestamp_ntz, "
                                     "acc_x double, acc_y double, acc_z double")
    got = {r.event_id: r for r in mo.integrate_damped(df, width="5 seconds").collect()}
    v = [0.0, 0.0, 0.0]
    d = [0.0, 0.0, 0.0]
    prev_t = None
    for i, _, ts, ax, ay, az in rows:
        dt = 0.0 if prev_t is None else (ts - prev_t).total_seconds()
        prev_t = ts
        for k, a in enumerate((ax, ay, az + 9.81)):
            v[k] = 0.95 * (v[k] + a * dt)
            d[k] += v[k] * dt
        g = got[i]
        assert abs(g.dt - dt) < 1e-12
        assert abs(g.vel_x - v[0]) < 1e-9 and abs(g.vel_z - v[2]) < 1e-9
        assert abs(g.disp_y - d[1]) < 1e-9


def test_head_per_series_two_stage(spark):
    from scarp.operators.series import head_per_series
    rows = [(BASE + timedelta(seconds=3 * i + (k * 0.5)), f"s{k}", float(i)) for k in range(3) for i in range(200)]
    df = spark.createDataFrame(rows, "time timestamp_ntz, s string, value double")
    got = head_per_series(df, ["s"], 5, width="10 seconds").collect()
    assert len(got) == 15
    for k in range(3):
        assert sorted(r.value for r in got if r.s == f"s{k}") == [0.0, 1.0, 2.0, 3.0, 4.0]


def test_with_context_requires_cover(spark):
    df = spark.createDataFrame([(BASE,)], "t timestamp_ntz")
    with pytest.raises(ValueError):
        sq.with_context(df, "t", "60 seconds", "30 seconds")
    assert sq.duration_us("2 minutes") == 120_000_000


def test_epoch_micros_is_zone_free(spark):
    from scarp.operators.resample import epoch_micros
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT * FROM VALUES (TIMESTAMP_NTZ'2024-03-10 02:30:00.123456'), "
                       "(TIMESTAMP_NTZ'2024-03-10 03:00:00') AS v(t)")
        a, b = [r[0] for r in df.select(epoch_micros(df, "t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert a == 1710037800123456 and b == 1710039600000000   # DST gap: still monotone, wall-clock exact


def test_hot_bucket_is_split_in_order(spark):
    """One series bursts thousands of rows (many with equal times) into one bucket."""
    rnd = random.Random(11)
    rows = []
    for i in range(6000):
        s = "hot" if i < 5000 else "cold"
        # hot: 5000 rows inside one second, a few hundred sharing timestamps
        t = BASE + timedelta(microseconds=rnd.randrange(0, 1_000_000, 250) if s == "hot" else 10_000 * i)
        rows.append((i, s, t, float(rnd.randint(-9, 9)), rnd.choice([0.5, 0.97])))
    df = spark.createDataFrame(rows, "id long, s string, t timestamp_ntz, v double, a double")
    d, b = sq.assign_buckets(df, ["s"], "t", "id", "120 seconds", max_rows=400)
    assert b.splits >= 13
    per = d.groupBy("s", "_bucket").count().collect()
    assert max(r["count"] for r in per) < 1000            # the burst went to many buckets
    out = sq.linear_scan(d, ["s"], F.col("a"), [F.col("v")], ["y"], "t", "id", buckets=b)
    out = sq.with_previous(out, ["s"], ["v"], "t", "id")
    out = sq.running_sum(out, ["s"], "v", "c", "t", "id")
    got = {r.id: r for r in out.collect()}
    assert len(got) == 6000
    for rs in _series(rows).values():
        y, c, prev = 0.0, 0.0, None
        for r in rs:
            y = r[4] * y + r[3]
            c += r[3]
            g = got[r[0]]
            assert abs(g.y - y) < 1e-9 and abs(g.c - c) < 1e-9 and g.prev_v == prev
            prev = r[3]


def test_last_by_time_breaks_ties_with_large_ids(spark):
    from scarp.operators.resample import last_by_time
    t = BASE + timedelta(seconds=1)
    df = spark.createDataFrame([(9_000_000_000_000_000_001, t, 1.0), (9_000_000_000_000_000_000, t, 2.0),
                                (5, t - timedelta(microseconds=1), 3.0), (7, t, None)],
                               "id long, t timestamp_ntz, x double")
    r = df.agg(last_by_time(df, "x", "t", "id").alias("x")).first()
    assert r.x == 1.0        # same time: the larger id wins; NULL values are skipped
    plan = df.agg(last_by_time(df, "x", "t", "id"))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_failure_trend_prefix_method_matches_frames(spark):
    from scarp.operators import failure as fl
    rnd = random.Random(5)
    rows = [(BASE + timedelta(seconds=i), "c1" if i % 3 else "c2", 1000.0 if i % 7 == 0 else 50.0 - 0.2 * i
             + rnd.uniform(-1, 1)) for i in range(400)]
    df = spark.createDataFrame(rows, "window_start timestamp_ntz, cluster_id string, inv_velocity double")
    a = {(r.cluster_id, r.window_start): r for r in fl.time_to_failure(df).collect()}
    b = {(r.cluster_id, r.window_start): r for r in fl.time_to_failure(df, method="prefix").collect()}
    assert a.keys() == b.keys()
    for k in a:
        x, y = a[k], b[k]
        assert (x.slope is None) == (y.slope is None)
        if x.slope is not None:
            assert abs(x.slope - y.slope) <= 1e-8 * max(1.0, abs(x.slope))
        if x.ttf_seconds is not None and y.ttf_seconds is not None:
            assert abs(x.ttf_seconds - y.ttf_seconds) <= 1e-6 * max(1.0, abs(x.ttf_seconds))
