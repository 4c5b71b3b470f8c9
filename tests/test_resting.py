"""Resting vectors, packet rounding, ties at one time, and filling in order."""

import json
import os
import random
import statistics
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from scarp.functions import features as fx
from scarp.operators import metrics as mt
from scarp.operators import resting as rt
from scarp.operators import series as se
from scarp.plans import catalog
from scarp.sources import envelopes as ev
from scarp.streaming import jobs
from scarp.streaming.fill import forward_fill_windows
from scarp.streaming.state import rocksdb_state

T0 = datetime(2024, 1, 1)


def test_still_periods_give_the_mounting(spark):
    rnd = random.Random(1)
    mounts = {"a": (0.0, 0.0, -9.81), "b": (0.0, 1.7, -9.66), None: (-2.5, 0.3, -9.48)}
    rows, still = [], {k: [] for k in mounts}
    for sensor, base in mounts.items():
        for s in range(0, 600):
            moving = s // 60 % 2                                  # every other minute
            v = tuple(b + rnd.gauss(0, 1.5 if moving else 0.01) for b in base)
            rows.append((sensor, T0 + timedelta(seconds=s), *v))
            if not moving:
                still[sensor].append(v)
    rows += [("a", None, 1.0, 1.0, 1.0), ("a", T0, None, 1.0, 1.0), ("a", T0, float("nan"), 1.0, 1.0), ("few", T0, 5.0, 5.0, 5.0)]
    df = spark.createDataFrame(rows, "sensor_id string, event_time timestamp_ntz, acc_x double, acc_y double, acc_z double")
    got = {r.sensor_id: r for r in rt.resting_vectors(df).collect()}
    assert set(got) == set(mounts)
    for sensor, values in still.items():
        assert got[sensor].windows == 30 and got[sensor].n == 300
        for k, a in enumerate("xyz"):
            assert abs(got[sensor][f"base_acc_{a}"] - statistics.median(v[k] for v in values)) < 0.002
    joined = rt.with_resting(df, rt.resting_vectors(df)).withColumn("rms", fx.rms(*rt.dynamic()))
    assert joined.count() == len(rows)
    calm = joined.where("event_time IS NOT NULL AND sensor_id <> 'few' AND NOT isnan(acc_x) AND (minute(event_time) % 2) = 0")
    assert calm.agg(F.max("rms")).first()[0] < 0.05
    other = joined.where("sensor_id = 'few'").first()
    assert (other.base_acc_x, other.base_acc_y, other.base_acc_z) == fx.BASE_ACCELERATION


def test_planted_sensors_are_at_rest(spark):
    r = catalog.QUERIES["resting_vectors"](spark, "/root/testdata/sf0.01").collect()
    assert len(r) == 3 and all(x.rest_rms < 0.01 for x in r)
    for x in r:
        want = catalog.MOUNTING[x.sensor_id[-10:]]
        assert all(abs(x[f"base_acc_{a}"] - w) < 0.01 for a, w in zip("xyz", want))


def test_published_digits(spark):
    env = spark.createDataFrame([(((0.123456, None), 12.345, None),), ((None, 2.5, 3.14159),)],
                                "value struct<velocity:struct<x:double,y:double>,intensity:double,water_level:double>")
    got = [r.value for r in ev.round_packet(env).collect()]
    assert (got[0].velocity.x, got[0].velocity.y, got[0].intensity, got[0].water_level) == (0.1235, None, 12.35, None)
    assert got[1].velocity is None and got[1].water_level == 3.142


def test_equal_times_do_not_depend_on_arrival(spark):
    rows = [(T0, "c", "f", float(v), k) for k, v in enumerate([3, 9, 1, 7])]
    schema = "time timestamp_ntz, cluster_id string, field string, value double, id long"
    found = {(se.latest(spark.createDataFrame(order, schema).coalesce(1)).first().value,
              se.latest(spark.createDataFrame(order, schema).coalesce(1), tie_col="id").first().value,
              se.panel_stats(spark.createDataFrame(order, schema).drop("id").coalesce(1)).first()["last"]) for order in (rows, rows[::-1], rows[2:] + rows[:2])}
    assert len(found) == 1 and found.pop()[1] == 7.0
    samples = spark.createDataFrame([(T0, "m", "i", "x", float(v), k) for k, v in enumerate([3, 9, 1])],
                                    "ts timestamp_ntz, metric string, instance string, mode string, value double, sample_id long")
    assert mt.instant_select(samples).first().value == 1.0


def test_fill_in_order_over_a_restart(spark, tmpdir_local):
    def write(n, lines):
        os.makedirs(f"{tmpdir_local}/in", exist_ok=True)
        path = f"{tmpdir_local}/in/{n}.txt"
        with open(path, "w") as f:
            f.write("\n".join(lines) + "\n")
        os.utime(path, (1_700_000_000 + n,) * 2)

    def packet(s, x=None):
        value = {"vn2000": {"x": x, "y": 1.0}} if x is not None else {"intensity": 1.0}
        kind = "gnss" if x is not None else "rain"
        return json.dumps({"key": str(s), "value": json.dumps({"timestamp": (T0 + timedelta(seconds=s, milliseconds=500)).isoformat(),
                                                               "sensor_id": f"{kind}_01_cluster_01", "sensor_type": kind, "value": value})})

    def run():
        with rocksdb_state(spark):
            filled = forward_fill_windows(jobs.alert_stream(jobs.stream_features(jobs.message_stream(spark, f"{tmpdir_local}/in"))), "cluster_id", ["last_gnss_x"])
            q = jobs.write_table(filled, f"{tmpdir_local}/out", f"{tmpdir_local}/ck", trigger={"availableNow": True})
        q.awaitTermination()

    write(0, [packet(3), packet(1, 10.0), packet(2)])
    write(1, [packet(8), packet(5), packet(4)])                   # out of order inside the watermark
    run()
    write(2, [packet(20), packet(15, 30.0), packet(12)])
    write(3, [packet(40)])
    run()
    got = {(r.window_start - T0).seconds: r.last_gnss_x_filled for r in spark.read.parquet(f"{tmpdir_local}/out").collect()}
    assert got == {1: 10.0, 2: 10.0, 3: 10.0, 4: 10.0, 5: 10.0, 8: 10.0, 12: 10.0, 15: 30.0, 20: 30.0}
