"""Input the registered queries do not hold: NULL keys, fresh checkpoints, late rows, odd ids and numbers."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from scarp import session
from scarp.functions import parse as ps
from scarp.operators import metrics as mt
from scarp.operators import motion as mo
from scarp.operators import sequence as sq
from scarp.sources import envelopes as ev
from scarp.streaming import jobs
from scarp.streaming.fill import forward_fill_stream
from scarp.streaming.sink import PointsWriter, compact_points, read_alerts, read_latest

T0 = datetime(2024, 1, 1)
WINDOWS = ("window struct<start:timestamp,end:timestamp>, cluster_id string, inv_velocity double, avg_velocity double, "
           "max_vibration double, rain_intensity double, pore_pressure double, last_gnss_x double, last_gnss_y double, "
           "alert_level int")


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def window(seconds, level, velocity=0.5):
    return ((at(seconds), at(seconds + 1)), "cluster_01", 2.0, velocity, 0.2, None, None, 1.0, 2.0, level)


def same_for_null_and_empty(spark, run, column):
    """Rows of a NULL series get what the same rows get under a name."""
    out = []
    for name in ("s", None):
        out.append(sorted(tuple(r) for r in run(name).drop(column).collect()))
    assert out[0] == out[1] and out[0]
    return out[0]


def test_null_series_keep_their_carries(spark):
    def rain(name):
        rows = [(k, at(60 * k), name, 3600.0) for k in range(7)]
        df = spark.createDataFrame(rows, "event_id long, event_time timestamp_ntz, sensor_id string, intensity double")
        return mo.rain_accumulation(df).select("event_id", "sensor_id", "accumulated")
    assert [r[1] for r in same_for_null_and_empty(spark, rain, "sensor_id")] == [60.0 * k for k in range(7)]

    def fill(name):
        rows = [(at(60 * k), name, 1.0 if k == 0 else None) for k in range(7)]
        df = spark.createDataFrame(rows, "event_time timestamp_ntz, sensor_id string, x double")
        return sq.forward_fill(df, ["sensor_id"], ["x"], tie_col=None).select("event_time", "sensor_id", "x_filled")
    assert {r[1] for r in same_for_null_and_empty(spark, fill, "sensor_id")} == {1.0}

    def moved(name):
        rows = [(k, at(50 * k), name, 1.0 * k, 0.0) for k in range(6)]
        df = spark.createDataFrame(rows, "event_id long, event_time timestamp_ntz, sensor_id string, x double, y double")
        return mo.gnss_displacement(df).select("event_id", "sensor_id", "displacement", "step")
    assert len(same_for_null_and_empty(spark, moved, "sensor_id")) == 6

    def speed(name):
        rows = [(k, at(45 * k), name, 0.1, 0.2, -9.7) for k in range(8)]
        df = spark.createDataFrame(rows, "event_id long, event_time timestamp_ntz, sensor_id string, acc_x double, acc_y double, acc_z double")
        return mo.integrate_damped(df).select("event_id", "sensor_id", "vel_x", "disp_x")
    same_for_null_and_empty(spark, speed, "sensor_id")


def test_missing_label_counts_as_empty(spark):
    out = []
    for mode in ("", None):
        rows = [(k, at(15 * k), "m", "h", mode, 50.0 * k) for k in range(24)]
        df = spark.createDataFrame(rows, "sample_id long, ts timestamp_ntz, metric string, instance string, mode string, value double")
        out.append(sorted(tuple(r) for r in mt.counter_rate(df).select("sample_id", "mode", "rate").collect()))
    assert out[0] == out[1] and all(abs(r[2] - 50 / 15) < 1e-9 for r in out[0][1:])


def test_fresh_checkpoint_keeps_stored_points(spark, tmpdir_local):
    def write(query, batch, rows):
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", query)
        try:
            PointsWriter(f"{tmpdir_local}/p")(spark.createDataFrame(rows, WINDOWS), batch)
        finally:
            spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)
    write("a", 0, [window(0, 3), window(1, 1)])
    write("a", 1, [window(1, 3)])
    write("b", 0, [window(2, 1), window(1, 2)])            # a new checkpoint starts at 0 again
    write("b", 0, [window(2, 1), window(1, 2)])            # replayed
    got = {(r.time - T0).seconds: r.alert_level for r in read_latest(spark, f"{tmpdir_local}/p").collect()}
    assert got == {0: 3.0, 1: 2.0, 2: 1.0}
    latest = read_latest(spark, f"{tmpdir_local}/p")
    assert "SortAggregate" not in latest._jdf.queryExecution().executedPlan().toString()
    compact_points(spark, f"{tmpdir_local}/p", f"{tmpdir_local}/c")
    assert sorted(map(tuple, read_latest(spark, f"{tmpdir_local}/c").collect())) == sorted(map(tuple, latest.collect()))
    assert spark.read.parquet(f"{tmpdir_local}/c").count() == 3


def test_withdrawn_alert_leaves_the_log(spark, tmpdir_local):
    w = PointsWriter(f"{tmpdir_local}/p", f"{tmpdir_local}/a")
    w(spark.createDataFrame([window(0, 3), window(1, 2), window(2, 1)], WINDOWS), 0)
    for _ in range(2):                                      # the second time as a replay
        w(spark.createDataFrame([window(0, 1), window(2, 1)], WINDOWS), 1)
    assert {(r.time - T0).seconds: r.alert_message for r in read_alerts(spark, f"{tmpdir_local}/a").collect()} == {
        1: "WARNING: HIGH RISK CONDITIONS"}
    log = spark.read.parquet(f"{tmpdir_local}/a").collect()
    assert sorted(((r.time - T0).seconds, int(r.alert_level), r.batch) for r in log) == [(0, 1, 1), (0, 3, 0), (1, 2, 0)]


def test_ids_from_kafka_break_ties_in_any_order(spark):
    from scarp.operators import resample as rs
    value = '{"timestamp": "2024-01-01T00:00:00.5", "sensor_id": "g_cluster_01", "sensor_type": "gnss", "value": {"vn2000": {"x": %s, "y": 0.0}}}'
    rows = [(p, 7, value % x) for p, x in ((0, "1.0"), (1, "2.0"), (2, "3.0"))]
    seen = set()
    for order in (rows, rows[::-1]):
        raw = spark.createDataFrame(order, "partition int, offset long, value string").coalesce(1)
        f = jobs.stream_features(jobs.kafka_messages(raw))
        assert f.select("msg_id").distinct().count() == 3
        seen.add(f.groupBy("cluster_id").agg(rs.last_by_time(f, "gnss_x", tie_col="msg_id").alias("x")).first().x)
    assert seen == {3.0}
    odd = spark.createDataFrame([(None, value % "1.0"), ("abc", value % "2.0"), ("-5", value % "NaN")], "key string, value string")
    out = jobs.stream_features(odd)
    assert [r.msg_id >= 0 for r in out.collect()] == [True] * 3
    assert sorted(r.gnss_x or 0 for r in out.collect()) == [0, 1.0, 2.0]   # NaN is missing
    assert out.groupBy("cluster_id").agg(rs.last_by_time(out, "gnss_x", tie_col="msg_id").alias("x")).first().x in (1.0, 2.0)


def test_zoned_time_is_one_instant_in_batch_and_stream(spark):
    df = spark.createDataFrame([("2024-01-01T07:00:00+07:00",), ("2024-01-01T00:00:00Z",), ("2024-01-01T00:00:00",), ("x",)], "t string")
    r = df.select(ps.parse_event_time("t", True).cast("string").alias("a"), ps.parse_event_time("t", False).cast("string").alias("b")).collect()
    assert [tuple(x) for x in r] == [("2024-01-01 00:00:00",) * 2] * 3 + [(None, None)]


def test_text_sink_of_a_stream(spark, tmpdir_local):
    src = spark.createDataFrame([("1", "{}")], "key string, value string")
    src.write.parquet(f"{tmpdir_local}/in")
    stream = spark.readStream.schema(src.schema).parquet(f"{tmpdir_local}/in")
    ev.write_envelopes(stream, "text", path=f"{tmpdir_local}/out", checkpoint=f"{tmpdir_local}/ck",
                       trigger={"availableNow": True}).awaitTermination()
    assert [r.value for r in spark.read.text(f"{tmpdir_local}/out").collect()] == ["{}"]


def test_late_row_neither_fills_nor_replaces(spark, tmpdir_local):
    schema = "time timestamp, k string, x double"
    batches = [[(at(10), "c", 5.0)], [(at(3), "c", 1.0), (at(2), "c", None), (at(11), "c", None)], [(at(4), "c", None), (at(12), "c", None)]]
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmpdir_local}/in")
    files = sorted((os.path.getmtime(os.path.join(f"{tmpdir_local}/in", f)), f) for f in os.listdir(f"{tmpdir_local}/in") if f.endswith(".parquet"))
    for k, (_, f) in enumerate(files):
        os.utime(os.path.join(f"{tmpdir_local}/in", f), (1_700_000_000 + k,) * 2)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmpdir_local}/in")
    q = (forward_fill_stream(stream, ["k"], ["x"], "time").writeStream.format("parquet").option("path", f"{tmpdir_local}/out")
         .option("checkpointLocation", f"{tmpdir_local}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    got = {(r.time - T0).seconds: r.x_filled for r in spark.read.parquet(f"{tmpdir_local}/out").collect()}
    assert got == {10: 5.0, 3: 1.0, 2: None, 11: 5.0, 4: None, 12: 5.0}


def test_cluster_without_checkpoint_folder_is_refused():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Spark:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Spark())


def test_kafka_options(monkeypatch):
    seen = {}

    class Reader:
        def format(self, name):
            seen["format"] = name
            return self

        def options(self, **opts):
            seen.update(opts)
            return self

        def load(self):
            return "frame"

    class Spark:
        readStream = Reader()
    assert ev.read_envelopes(Spark(), "kafka", servers="h:1", topic="t", fail_on_data_loss=False) == "frame"
    assert seen == {"format": "kafka", "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "latest", "failOnDataLoss": "false"}
