"""Streams equal batches; late data is dropped; restarts replay idempotently."""

import json
import os
import time
import uuid

from pyspark.sql import functions as F

from scarp.plans import catalog, replay
from scarp.session import scratch_path
from scarp.streaming import jobs
from scarp.streaming.fill import forward_fill_stream
from scarp.streaming.sink import read_latest

SF_SMALL = "/root/testdata/sf0.001"


def _packet(ts, v, sensor="imu", cluster="cluster_01"):
    value = {"velocity": {"x": v, "y": 0.0}, "acceleration": {"rms": 0.1}} if sensor == "imu" else {"intensity": v}
    return json.dumps({"key": str(uuid.uuid4().int % 10**9),
                       "value": json.dumps({"timestamp": ts, "sensor_id": f"{sensor}_01_{cluster}",
                                            "sensor_type": sensor, "value": value})})


def _write(path, name, lines, mtime):
    os.makedirs(path, exist_ok=True)
    p = os.path.join(path, name)
    with open(p, "w") as f:
        f.write("\n".join(lines) + "\n")
    os.utime(p, (mtime, mtime))


def test_append_stream_equals_closed_batch_windows(spark):
    got = catalog.QUERIES["stream_alerts_append"](spark, SF_SMALL)
    batch = catalog.QUERIES["alerts_by_cluster"](spark, SF_SMALL).drop("has_imu")
    wm = batch.agg(F.max("window_end")).first()[0]
    n_stream = got.count()
    # every emitted window is final and equal to the batch row
    assert got.exceptAll(batch).count() == 0
    assert 0 < n_stream <= batch.count()
    assert batch.where(F.col("window_end") <= F.lit(wm) - F.expr("INTERVAL 11 SECONDS")).count() <= n_stream


def test_late_row_is_dropped(spark, tmpdir_local):
    src = os.path.join(tmpdir_local, "in")
    t0 = 1_700_000_000
    _write(src, "a.txt", [_packet("2024-01-01T00:00:00.5", 0.5), _packet("2024-01-01T00:00:30.0", 0.5)], t0)
    _write(src, "b.txt", [_packet("2024-01-01T00:00:25.0", 0.2)], t0 + 1)          # 5 s late: kept
    _write(src, "c.txt", [_packet("2024-01-01T00:00:00.7", 5.0)], t0 + 2)          # 29 s late: dropped
    _write(src, "d.txt", [_packet("2024-01-01T00:01:00.0", 0.5)], t0 + 3)
    out = os.path.join(tmpdir_local, "out")
    feats = jobs.stream_features(jobs.message_stream(spark, src))
    q = jobs.start_append_job(feats, out, os.path.join(tmpdir_local, "ck"), trigger={"availableNow": True})
    q.awaitTermination()
    dropped = sum(p.get("stateOperators", [{}])[0].get("numRowsDroppedByWatermark", 0) for p in
                  [json.loads(x.json) for x in q.recentProgress])
    res = {str(r.window_start): r for r in spark.read.parquet(out).collect()}
    first = [r for k, r in res.items() if k.endswith("00:00:00")][0]
    assert abs(first.avg_velocity - 0.5) < 1e-12      # late 5.0 did not change the window
    assert any(k.endswith("00:00:25") for k in res)   # 5 s late row kept
    assert dropped > 0


def test_upsert_restart_is_idempotent(spark, tmpdir_local):
    src = os.path.join(tmpdir_local, "in")
    base = os.path.join(tmpdir_local, "sink")
    t0 = 1_700_000_000
    _write(src, "a.txt", [_packet("2024-01-01T00:00:00.5", 0.5), _packet("2024-01-01T00:00:00.6", 0.3),
                          _packet("2024-01-01T00:00:01.0", 60.0, "rain")], t0)

    def run():
        feats = jobs.stream_features(jobs.message_stream(spark, src))
        q = jobs.start_monitoring_job(feats, f"{base}/points", f"{base}/ck", alerts_path=f"{base}/alerts",
                                      audit_path=f"{base}/audit", trigger={"availableNow": True})
        q.awaitTermination()
        return q

    q = run()
    observed = [p.observedMetrics.get("alert_rows") for p in q.recentProgress if p.numInputRows]
    assert observed and observed[0]["rows"] == 2 and observed[0]["alerts"] == 2   # danger + heavy rain
    first = sorted(map(tuple, read_latest(spark, f"{base}/points").collect()))
    _write(src, "b.txt", [_packet("2024-01-01T00:00:00.9", 0.1), _packet("2024-01-01T00:00:05.0", 0.01)], t0 + 1)
    run()                                    # restart on the same checkpoint picks up only the new file
    pts = {str(r.time): r for r in read_latest(spark, f"{base}/points").collect()}
    assert abs(pts["2024-01-01 00:00:00"].avg_velocity - 0.3) < 1e-12
    assert pts["2024-01-01 00:00:01"].alert_level == 2
    assert len(first) == 2 and len(pts) == 3
    audit = spark.read.parquet(f"{base}/audit")
    assert audit.agg(F.sum("points")).first()[0] == 4     # 2 points, then 2 updated/new points
    alerts = spark.read.parquet(f"{base}/alerts")
    assert alerts.where("alert_level = 2").count() >= 1


def test_stream_forward_fill_across_batches(spark, tmpdir_local):
    from pyspark.sql import types as T
    src = os.path.join(tmpdir_local, "pts")
    schema = T.StructType([T.StructField("time", T.TimestampType()), T.StructField("cluster_id", T.StringType()),
                           T.StructField("gx", T.DoubleType())])
    batches = [[("2024-01-01 00:00:01", "c1", 1.0), ("2024-01-01 00:00:02", "c1", None)],
               [("2024-01-01 00:00:03", "c1", None), ("2024-01-01 00:00:04", "c2", None)],
               [("2024-01-01 00:00:05", "c1", 7.0), ("2024-01-01 00:00:06", "c1", None)]]
    for i, b in enumerate(batches):
        df = spark.createDataFrame(b, "t string, cluster_id string, gx double").select(
            F.col("t").cast("timestamp").alias("time"), "cluster_id", "gx")
        df.coalesce(1).write.mode("append").parquet(src)
    files = sorted((os.path.getmtime(os.path.join(src, f)), f) for f in os.listdir(src) if f.endswith(".parquet"))
    for i, (_, f) in enumerate(files):
        os.utime(os.path.join(src, f), (1_700_000_000 + i,) * 2)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    filled = forward_fill_stream(stream, ["cluster_id"], ["gx"], "time")
    name = "ffill_" + uuid.uuid4().hex[:8]
    q = (filled.writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", scratch_path(spark, "tests", "ffill")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = {(r.cluster_id, str(r.time)[-2:]): r.gx_filled for r in spark.sql(f"select * from {name}").collect()}
    assert got[("c1", "02")] == 1.0 and got[("c1", "03")] == 1.0
    assert got[("c1", "06")] == 7.0 and got[("c2", "04")] is None


def test_duplicates_suppressed_when_asked(spark, tmpdir_local):
    src = os.path.join(tmpdir_local, "in")
    p = _packet("2024-01-01T00:00:00.5", 0.5)
    q_ = json.loads(p)
    dup = json.dumps({"key": str(int(q_["key"]) + 1), "value": q_["value"]})
    _write(src, "a.txt", [p, dup, _packet("2024-01-01T00:00:00.6", 0.2)], 1_700_000_000)
    _write(src, "b.txt", [_packet("2024-01-01T00:00:40.0", 0.5)], 1_700_000_001)
    res = {}
    for dedupe in (False, True):
        out = os.path.join(tmpdir_local, f"out{dedupe}")
        feats = jobs.stream_features(jobs.message_stream(spark, src))
        q = jobs.start_append_job(feats, out, os.path.join(tmpdir_local, f"ck{dedupe}"),
                                  trigger={"availableNow": True}, dedupe=dedupe)
        q.awaitTermination()
        res[dedupe] = spark.read.parquet(out).where("cluster_id = 'cluster_01'").orderBy("window_start").first()
    assert abs(res[False].avg_velocity - 0.4) < 1e-12     # duplicate counted twice
    assert abs(res[True].avg_velocity - 0.35) < 1e-12     # once


def test_core_job_console_and_memory(spark, tmpdir_local):
    src = os.path.join(tmpdir_local, "in")
    _write(src, "a.txt", [_packet("2024-01-01T00:00:00.5", 0.5), _packet("2024-01-01T00:00:00.7", 60.0, "rain")],
           1_700_000_000)
    feats = jobs.stream_features(jobs.message_stream(spark, src))
    name = "core_" + uuid.uuid4().hex[:8]
    q = jobs.start_core_job(feats, os.path.join(tmpdir_local, "ck"), sink="memory", path=name,
                            trigger={"availableNow": True})
    q.awaitTermination()
    r = spark.sql(f"select * from {name}").first()
    assert r.alert_level == "DANGER: LANDSLIDE IMMINENT" and str(r.inv_velocity) == "2.00"
    feats2 = jobs.stream_features(jobs.message_stream(spark, src))
    q2 = jobs.start_core_job(feats2, os.path.join(tmpdir_local, "ck2"), trigger={"availableNow": True})
    q2.awaitTermination()
    assert q2.exception() is None


def test_kafka_source_is_wired(spark):
    from scarp.sources import envelopes as ev
    try:
        ev.read_envelopes(spark, "kafka", servers="127.0.0.1:1", topic="t", fail_on_data_loss=False)
    except Exception as e:  # the connector jar is not bundled here; the call reaches the kafka provider
        assert "kafka" in str(e).lower()


def test_audit_listener_sees_observed_metrics(spark, tmpdir_local):
    from scarp.streaming.sink import AuditListener
    src = os.path.join(tmpdir_local, "in")
    _write(src, "a.txt", [_packet("2024-01-01T00:00:00.5", 0.5), _packet("2024-01-01T00:00:03.0", 0.001)],
           1_700_000_000)
    listener = AuditListener()
    spark.streams.addListener(listener)
    try:
        feats = jobs.stream_features(jobs.message_stream(spark, src))
        q = jobs.start_monitoring_job(feats, f"{tmpdir_local}/points", f"{tmpdir_local}/ck",
                                      trigger={"availableNow": True})
        q.awaitTermination()
        time.sleep(1.0)                       # listener events are delivered asynchronously
    finally:
        spark.streams.removeListener(listener)
    seen = [b for b in listener.batches if b.get("rows")]
    assert seen and seen[0]["rows"] == 2 and seen[0]["alerts"] == 1


def test_points_writer_replay_is_idempotent(spark, tmpdir_local):
    """Re-running a micro-batch (same batch id, e.g. after an executor loss) leaves the same tables."""
    from datetime import datetime
    from scarp.streaming.sink import PointsWriter
    t0 = datetime(2024, 1, 1)
    batch = spark.createDataFrame(
        [((t0, t0), "cluster_01", 2.0, 0.5, 0.2, None, None, 1.0, 2.0, 3),
         ((t0, t0), "cluster_02", 1000.0, None, 0.1, 10.0, 20.0, None, None, 1)],
        "window struct<start:timestamp,end:timestamp>, cluster_id string, inv_velocity double, "
        "avg_velocity double, max_vibration double, rain_intensity double, pore_pressure double, "
        "last_gnss_x double, last_gnss_y double, alert_level int")
    w = PointsWriter(f"{tmpdir_local}/p", f"{tmpdir_local}/a", f"{tmpdir_local}/au")
    w(batch, 7)
    first = sorted(map(tuple, read_latest(spark, f"{tmpdir_local}/p").collect()))
    w(batch, 7)
    assert sorted(map(tuple, read_latest(spark, f"{tmpdir_local}/p").collect())) == first
    assert spark.read.parquet(f"{tmpdir_local}/p").count() == 2
    assert spark.read.parquet(f"{tmpdir_local}/a").count() == 1
    assert spark.read.parquet(f"{tmpdir_local}/au").first().points == 2
    w(batch.limit(0), 8)                                  # empty batch: nothing written
    assert not [d for d, _, _ in os.walk(f"{tmpdir_local}/p") if d.endswith("batch=8")]


def test_kafka_shaped_rows_feed_the_parser(spark):
    raw = spark.createDataFrame([(bytearray(b"k"), bytearray(json.loads(_packet("2024-01-01T00:00:00.5", 0.5))["value"]
                                                            .encode()), "landslide_data", 0, 42)],
                                "key binary, value binary, topic string, partition int, offset long")
    f = jobs.stream_features(jobs.kafka_messages(raw)).first()
    assert f.msg_id == 42 and f.sensor_type == "imu" and abs(f.imu_velocity - 0.5) < 1e-12


def test_out_of_order_within_watermark_gives_the_batch_result(spark, tmpdir_local):
    """Readings near each slice boundary arrive one file late (< 10 s behind): same final table."""
    from scarp.sources import envelopes as ev
    readings = catalog.load_readings(spark, SF_SMALL)
    env = ev.envelope(readings, carry=("event_id", "us"))
    fields = [c for c in env.columns if c not in ("event_id", "us")]
    msgs = env.select("us", F.to_json(F.struct(F.col("event_id").cast("string").alias("key"),
                                                F.to_json(F.struct(*fields)).alias("value"))).alias("line"))
    lo, hi = readings.agg(F.min("us"), F.max("us")).first()
    step = (hi - lo) // 4 + 1
    src = os.path.join(tmpdir_local, "in")
    late = 0
    for k in range(4):
        start, end = lo + k * step, lo + (k + 1) * step
        own = (F.col("us") >= start) & (F.col("us") < end - 3_000_000)         # last 3 s of a slice ...
        delayed = (F.col("us") >= start - 3_000_000) & (F.col("us") < start)  # ... arrive with the next one
        part = msgs.where(own | delayed) if k else msgs.where(own)
        if k == 3:
            part = msgs.where((F.col("us") >= start - 3_000_000))
        late += part.where(delayed).count() if k else 0
        lines = [r.line for r in part.orderBy(F.rand(k)).collect()]
        _write(src, f"{k}.txt", lines, 1_700_000_000 + k)
    assert late > 0
    base = os.path.join(tmpdir_local, "sink")
    feats = jobs.stream_features(jobs.message_stream(spark, src))
    q = jobs.start_monitoring_job(feats, f"{base}/points", f"{base}/ck", trigger={"availableNow": True})
    q.awaitTermination()
    got = catalog._point_cols(read_latest(spark, f"{base}/points"))
    want = catalog.QUERIES["alerts_by_cluster"](spark, SF_SMALL).select(
        F.col("window_start").alias("time"), "cluster_id", "inv_velocity", "avg_velocity", "max_vibration",
        "rain_intensity", "pore_pressure", F.col("last_gnss_x").alias("gnss_x"),
        F.col("last_gnss_y").alias("gnss_y"), F.col("alert_level").cast("double").alias("alert_level"))
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0


def test_sequential_slices_replay_in_time_order(spark, tmpdir_local):
    src = os.path.join(tmpdir_local, "seq")
    n = replay.write_time_slices(catalog.load_readings(spark, SF_SMALL), src, slices=3, sequential=True)
    files = sorted((os.path.getmtime(os.path.join(src, f)), f) for f in os.listdir(src) if f.endswith(".txt"))
    assert n == 3 and len(files) == 3
    spans = []
    for _, f in files:
        stamps = [json.loads(json.loads(l)["value"])["timestamp"] for l in open(os.path.join(src, f)) if l.strip()]
        spans.append((min(stamps), max(stamps)))
    assert all(spans[i][1] < spans[i + 1][0] for i in range(2))       # slices follow event time


def test_points_are_date_partitioned_and_ranges_prune(spark, tmpdir_local):
    from datetime import datetime
    from scarp.operators import series as se
    from scarp.streaming.sink import PointsWriter
    rows = [((datetime(2024, 1, d, 12), datetime(2024, 1, d, 12)), "cluster_01", 5.0, 0.2, 0.1, None, None,
             None, None, 3) for d in (1, 2, 3)]
    batch = spark.createDataFrame(rows, "window struct<start:timestamp,end:timestamp>, cluster_id string, "
                                        "inv_velocity double, avg_velocity double, max_vibration double, "
                                        "rain_intensity double, pore_pressure double, last_gnss_x double, "
                                        "last_gnss_y double, alert_level int")
    PointsWriter(f"{tmpdir_local}/p")(batch, 0)
    assert sorted(d for d in os.listdir(f"{tmpdir_local}/p") if d.startswith("date=")) == \
        ["date=2024-01-01", "date=2024-01-02", "date=2024-01-03"]
    latest = read_latest(spark, f"{tmpdir_local}/p")
    recent = se.time_range(latest, "1 day")
    assert recent.count() == 2
    import re
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert any("date" in f for f in re.findall(r"PartitionFilters: \[[^\]]*\]", plan))   # days pruned at the scan
