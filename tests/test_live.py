"""Live sequence operators, trend, ingest and reconciliation: equal to plain or batch results, over restarts and replays."""

import json
import os
import random
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from scarp.functions import parse as ps
from scarp.plans import alerts as al
from scarp.streaming import files, ingest, jobs, ordered
from scarp.streaming.sink import PointsWriter, read_latest, run_number
from scarp.streaming.state import rocksdb_state, state_rows
from scarp.streaming.trend import time_to_failure_stream

T0 = datetime(2024, 1, 1)


def message(key, seconds, sensor="rain_01_cluster_01", **value):
    stamp = (T0 + timedelta(seconds=seconds)).isoformat()
    return json.dumps({"key": str(key), "value": json.dumps({"timestamp": stamp, "sensor_id": sensor, "sensor_type": sensor.split("_")[0], "value": value})})


def deliver(folder, number, lines):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f"{number:03d}.txt")
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    os.utime(path, (1_700_000_000 + number,) * 2)


def run_ordered(spark, base, sensor, operator):
    with rocksdb_state(spark):
        rows = operator(jobs.stream_readings(jobs.message_stream(spark, f"{base}/in"), sensor))
        query = jobs.write_table(rows, f"{base}/out", f"{base}/ck", trigger={"availableNow": True})
    query.awaitTermination()
    return query


def micros(r):
    return int((r.event_time - T0) / timedelta(microseconds=1))


def plain_rain(rows, reset=None):
    """(sensor, us, id) -> (dt, accumulated) of rows (sensor, us, id, intensity) in time order."""
    out, last, total = {}, {}, {}
    for sensor, us, key, v in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        before = last.get(sensor)
        new = before is None or (reset and before // reset != us // reset)
        dt = 0.0 if new else (us - before) / 1e6
        total[sensor] = (0.0 if new else total[sensor]) + (0.0 if v is None else v / 3600.0 * dt)
        last[sensor] = us
        out[sensor, us, key] = (dt, total[sensor])
    return out


@pytest.mark.parametrize("reset", [None, "20 seconds"])
def test_rain_out_of_order_over_a_restart(spark, tmpdir_local, reset):
    rnd = random.Random(4)
    rows = [(f"rain_0{s}_cluster_01", rnd.randrange(0, 90_000_000), k, rnd.choice([None, rnd.uniform(0, 50)])) for k, s in
            enumerate([1] * 150 + [2] * 40)]
    rows += [("rain_01_cluster_01", 5_000_000, 900 + k, 36.0) for k in range(5)]          # ties
    rows += [("rain_03_cluster_01", 1_000_000, 990, 3.0)]                                 # a series of one early row
    arrival = sorted(rows, key=lambda r: r[1] + rnd.randrange(0, 8_000_000))              # up to 8 s late
    half = len(arrival) // 2
    batches = [arrival[k:k + 30] for k in range(0, len(arrival), 30)]
    for n, part in enumerate(batches):
        if n * 30 >= half > (n - 1) * 30:
            run_ordered(spark, tmpdir_local, "rain", lambda m: ordered.rain_accumulation_stream(m, reset=reset))
        deliver(f"{tmpdir_local}/in", n, [message(k, us / 1e6, s, **({} if v is None else {"intensity": v})) for s, us, k, v in part])
    run_ordered(spark, tmpdir_local, "rain", lambda m: ordered.rain_accumulation_stream(m, reset=reset))
    got = {(r.sensor_id, micros(r), r.msg_id): (r.dt, r.accumulated) for r in spark.read.parquet(f"{tmpdir_local}/out").collect()}
    want = plain_rain(rows, 20_000_000 if reset else None)
    newest = max(r[1] for r in rows)
    passed = {k: v for k, v in want.items() if k[1] <= newest // 1000 * 1000 - 10_000_000}
    assert set(got) == set(passed) and len(passed) > 100
    assert ("rain_03_cluster_01", 1_000_000, 990) in got
    for k, (dt, total) in passed.items():
        assert got[k][0] == dt and abs(got[k][1] - total) < 1e-9
    # what is held is what the watermark has not passed
    held = state_rows(spark, f"{tmpdir_local}/ck", variable="held")
    assert held.count() == len(want) - len(passed)


def test_damped_recurrence_in_blocks():
    rng = np.random.default_rng(1)
    x = rng.normal(size=1000)
    y, before = [], 3.0
    for v in x:
        before = 0.95 * (before + v)
        y.append(before)
    assert np.allclose(ordered.damped(x, 3.0, 0.95), y, rtol=1e-12, atol=1e-12)
    assert np.allclose(np.concatenate([ordered.damped(x[:300], 3.0, 0.95), ordered.damped(x[300:], y[299], 0.95)]), y)


def test_motion_keeps_on_over_batches(spark, tmpdir_local):
    rnd = random.Random(5)
    rows = [(k, k * 0.5 + rnd.random() * 0.4, [rnd.uniform(-1, 1) for _ in "xyz"]) for k in range(100)]
    for n in range(4):
        deliver(f"{tmpdir_local}/in", n, [message(k, t, "imu_01_cluster_01", acceleration=dict(zip("xyz", a))) for k, t, a in rows[n * 25:(n + 1) * 25][::-1]])
    run_ordered(spark, tmpdir_local, "imu", ordered.integrate_damped_stream)
    got = {r.msg_id: r for r in spark.read.parquet(f"{tmpdir_local}/out").collect()}
    v, d, last = [0.0] * 3, [0.0] * 3, None
    base = (0.0, 0.0, -9.81)
    for k, t, a in rows:
        us = round(t * 1e6)
        dt = 0.0 if last is None else (us - last) / 1e6
        last = us
        v = [0.95 * (v[i] + (a[i] - base[i]) * dt) for i in range(3)]
        d = [d[i] + v[i] * dt for i in range(3)]
        if k in got:
            r = got[k]
            assert np.allclose([r.vel_x, r.vel_y, r.vel_z, r.disp_x, r.disp_y, r.disp_z], v + d, rtol=1e-9, atol=1e-9)
    assert 60 <= len(got) < 100


def test_trend_with_gaps(spark, tmpdir_local):
    points = [(s, 0.05 + 0.004 * s) for s in (*range(0, 40), *range(70, 75), 200, 201, 300)]
    for n in range(3):
        deliver(f"{tmpdir_local}/in", n, [message(s, s + 0.2, "imu_01_cluster_01", velocity={"x": v, "y": 0.0}) for s, v in points[n * 16:(n + 1) * 16]])
    trend = time_to_failure_stream(jobs.alert_stream(jobs.stream_features(jobs.message_stream(spark, f"{tmpdir_local}/in"))))
    jobs.write_table(trend, f"{tmpdir_local}/out", f"{tmpdir_local}/ck", trigger={"availableNow": True}).awaitTermination()
    got = {int((r.window_start - T0).total_seconds()): r for r in spark.read.parquet(f"{tmpdir_local}/out").collect()}
    assert set(got) == {s for s, _ in points if s < 300}
    for s, v in points[:-1]:
        x, y = zip(*[(t - s, 1 / w) for t, w in points if s - 60 <= t <= s])
        if len(x) == 1:
            assert got[s].slope is None and got[s].ttf_seconds is None
            continue
        slope, level = np.polyfit(x, y, 1)
        assert abs(got[s].slope - slope) < 1e-9 and abs(got[s].ttf_seconds + level / slope) < 1e-6


# ------------------------------------------------------------ ingest

def frame(spark, lines):
    return spark.createDataFrame([tuple(json.loads(line).values()) for line in lines], "key string, value string")


def counts(spark, base):
    return {k: ingest.readings(spark, base, k).count() for k in ingest.KINDS}


def test_every_message_is_kept_once(spark, tmpdir_local):
    base = f"{tmpdir_local}/t"
    job = ingest.Ingest(base)
    first = [message(k, k) for k in range(30)] + [json.dumps({"key": "bad", "value": "{no json"}), json.dumps({"key": "none", "value": None}),
                                                  json.dumps({"key": "t", "value": json.dumps({"sensor_type": "rain", "value": {"intensity": 1}})})]
    job(frame(spark, first), 0)
    assert counts(spark, base) == {"on_time": 30, "late": 0, "rejected": 3}
    before = {k: sorted(map(tuple, ingest.readings(spark, base, k).collect()), key=repr) for k in ingest.KINDS}
    job(frame(spark, first), 0)                                               # replayed: nothing twice
    assert {k: sorted(map(tuple, ingest.readings(spark, base, k).collect()), key=repr) for k in ingest.KINDS} == before
    # newest 29 s: windows that end at 19 s or earlier are closed
    job(frame(spark, [message(100, 18.5), message(101, 19.0), message(102, 18.999), message(103, 50)]), 1)
    late = {r.msg_id for r in ingest.readings(spark, base, "late").collect()}
    assert late == {100, 102} and counts(spark, base)["on_time"] == 32
    job(frame(spark, first).limit(0), 2)                                      # an empty batch keeps the watermark
    job(frame(spark, [message(104, 39.5)]), 3)
    assert {r.msg_id for r in ingest.readings(spark, base, "late").collect()} == {100, 102, 104}
    back = {r.key: (r.value, r.reason) for r in ingest.quarantined(spark, base).collect()}
    assert set(back) == {"bad", "none", "t"} and back["bad"] == ("{no json", "unparseable") and back["t"][1] == "missing_time"
    assert [r.key for r in ingest.quarantined(spark, base, "missing_time").collect()] == ["t"]


def test_a_crash_between_days_is_made_good(spark, tmpdir_local, monkeypatch):
    base, day = f"{tmpdir_local}/t", 86_400
    lines = [message(k, k * day / 2) for k in range(6)]                       # three days in one batch
    real, calls = files.publish, []

    def failing(s, a, b):
        calls.append(b)
        if len(calls) == 2:
            raise OSError("lost")
        return real(s, a, b)

    monkeypatch.setattr(files, "publish", failing)
    with pytest.raises(OSError):
        ingest.Ingest(base)(frame(spark, lines), 0)
    assert counts(spark, base)["on_time"] == 2                                # the oldest day came first
    monkeypatch.setattr(files, "publish", real)
    ingest.Ingest(base)(frame(spark, lines), 0)
    assert counts(spark, base)["on_time"] == 6


def test_reconciled_points_equal_the_batch(spark, tmpdir_local):
    base, points = f"{tmpdir_local}/t", f"{tmpdir_local}/p"
    job = ingest.Ingest(base)
    early = [message(k, k / 4, "imu_01_cluster_01", velocity={"x": 0.01 * k, "y": 0.0}) for k in range(200)]
    late = [message(1000 + k, k / 2, "imu_02_cluster_01", velocity={"x": 5.0, "y": 0.0}) for k in range(20)]
    job(frame(spark, early), 0)

    def aggregate():
        jobs.start_monitoring_job(ingest.reading_stream(spark, base), points, f"{tmpdir_local}/ck", trigger={"availableNow": True}).awaitTermination()

    aggregate()
    job(frame(spark, late), 1)
    aggregate()
    features, _ = ps.split_rejected(frame(spark, early + late), keep=("key",), ntz=False)
    want = al.monitoring_alerts(jobs.with_message_id(features), tie_col="msg_id")
    want = {r.window.start: r.avg_velocity for r in want.collect()}
    # the mean velocity of the windows touched is off until they are reconciled
    before = {r.time: r.avg_velocity for r in read_latest(spark, points).collect()}
    assert sum(abs(before[t] - v) > 1e-12 for t, v in want.items()) == 10
    assert ingest.reconcile(spark, base, points) == 20
    after = {r.time: r.avg_velocity for r in read_latest(spark, points).collect()}
    assert after.keys() == want.keys() and all(abs(after[t] - v) < 1e-12 for t, v in want.items())
    written = spark.read.parquet(points).groupBy("run").count().collect()
    assert sorted(r["count"] for r in written) == [10, 50]                    # only the windows touched came anew
    assert ingest.reconcile(spark, base, points) == 0


def test_writers_that_start_together_get_runs_of_their_own(spark, tmpdir_local):
    with ThreadPoolExecutor(8) as pool:
        runs = list(pool.map(lambda k: run_number(spark, f"{tmpdir_local}/p", f"q{k % 6}"), range(24)))
    by_query = {k: {r for j, r in enumerate(runs) if j % 6 == k} for k in range(6)}
    again = {k: run_number(spark, f"{tmpdir_local}/p", f"q{k}") for k in range(6)}
    assert all(again[k] in by_query[k] for k in range(6))
    assert len(set(again.values())) == 6                                      # no two queries share a number
    assert files.create_if_absent(spark, f"{tmpdir_local}/x/one", "a") and not files.create_if_absent(spark, f"{tmpdir_local}/x/one", "b")


def test_reconcile_writes_alerts_of_its_own_run(spark, tmpdir_local):
    t = datetime(2024, 1, 1, tzinfo=timezone.utc)
    batch = spark.createDataFrame([((t, t), "c", 2.0, 0.5, 0.2, None, None, 1.0, 2.0, 3)],
                                  "window struct<start:timestamp,end:timestamp>, cluster_id string, inv_velocity double, avg_velocity double, "
                                  "max_vibration double, rain_intensity double, pore_pressure double, last_gnss_x double, last_gnss_y double, alert_level int")
    for k in range(2):
        PointsWriter(f"{tmpdir_local}/p", query_id=f"job{k}")(batch, 0)
    assert {r.run for r in spark.read.parquet(f"{tmpdir_local}/p").collect()} == {1, 2}
    assert read_latest(spark, f"{tmpdir_local}/p").count() == 1


def test_state_stays_within_the_watermark(spark, tmpdir_local):
    for n in range(12):
        deliver(f"{tmpdir_local}/in", n, [message(n * 1000 + k, n * 20 + k / 5, f"rain_01_cluster_0{k % 3}", intensity=1.0) for k in range(100)])
    alerts = jobs.alert_stream(jobs.stream_features(jobs.message_stream(spark, f"{tmpdir_local}/in")))
    with rocksdb_state(spark):
        q = jobs.write_table(al.flat_window(alerts), f"{tmpdir_local}/out", f"{tmpdir_local}/ck", trigger={"availableNow": True})
    q.awaitTermination()
    totals = [p.stateOperators[0].numRowsTotal for p in q.recentProgress if p.stateOperators]
    # 20 s of windows a batch and 10 s inside the watermark, for three clusters
    assert len(totals) > 12 and max(totals) <= (20 + 10 + 1) * 3
    state = state_rows(spark, f"{tmpdir_local}/ck")
    assert state.count() == totals[-1] <= 11 * 3
    assert state.select(F.min("key.window.end")).first()[0] > T0 + timedelta(seconds=12 * 20 - 12)


def test_processing_time_trigger(spark, tmpdir_local):
    """The monitoring job's own trigger: micro-batches follow one another until the query is stopped."""
    deliver(f"{tmpdir_local}/in", 0, [message(1, 1.0, intensity=1.0)])
    feats = jobs.stream_features(jobs.message_stream(spark, f"{tmpdir_local}/in"))
    q = jobs.start_monitoring_job(feats, f"{tmpdir_local}/p", f"{tmpdir_local}/ck", trigger={"processingTime": "200 milliseconds"})
    try:
        q.processAllAvailable()
        deliver(f"{tmpdir_local}/in", 1, [message(2, 2.0, intensity=2.0)])
        q.processAllAvailable()
        assert q.isActive and read_latest(spark, f"{tmpdir_local}/p").count() == 2
        assert len({p.batchId for p in q.recentProgress if p.numInputRows}) == 2
    finally:
        q.stop()
    assert not q.isActive
