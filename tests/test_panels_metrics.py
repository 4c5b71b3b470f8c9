"""Panels, sink defaults, label selectors and series arithmetic on hand-made rows."""

from datetime import datetime, timedelta


from scarp.functions import panels as pn
from scarp.operators import metrics as mt
from scarp.operators import series as se
from scarp.operators import resample as rs

T0 = datetime(2024, 1, 1)


def test_threshold_bands_and_value_text(spark):
    df = spark.createDataFrame([(None,), (69.9,), (70.0,), (95.0,)], "cpu double")
    got = df.select(pn.threshold_band("cpu", pn.CPU_STEPS).alias("b")).collect()
    assert [r.b for r in got] == [None, "green", "yellow", "red"]
    m = spark.createDataFrame([(None,), (0.7,), (0.95,)], "m double").select(
        pn.threshold_band("m", pn.MEMORY_STEPS).alias("b")).collect()
    assert [r.b for r in m] == [None, "yellow", "red"]
    t = spark.createDataFrame([(1,), (2,), (3,), (None,), (7,)], "l int").select(pn.value_text("l").alias("t"))
    assert [r.t for r in t.collect()] == ["NORMAL", "WARNING", "DANGER", "N/A", "7"]


def test_points_defaults(spark):
    alerts = spark.createDataFrame(
        [((T0, T0 + timedelta(seconds=1)), "", 1000.0, None, 5.6, None, None, None, None, 2)],
        "window struct<start:timestamp_ntz,end:timestamp_ntz>, cluster_id string, inv_velocity double, "
        "avg_velocity double, max_vibration double, rain_intensity double, pore_pressure double, "
        "last_gnss_x double, last_gnss_y double, alert_level int")
    p = se.to_points(alerts).first()
    assert p.cluster_id == "unknown" and p.avg_velocity is None and p.alert_level == 2.0
    z = se.to_points(alerts, zero_fill=True).first()
    assert z.avg_velocity == 0.0 and z.gnss_x == 0.0
    long = se.points_long(se.to_points(alerts))
    assert sorted(r.field for r in long.collect()) == ["alert_level", "inv_velocity", "max_vibration"]


def _metrics(spark):
    rows = []
    for i in range(8):
        ts = T0 + timedelta(seconds=15 * i)
        rows += [(i, ts, "rx_bytes_total", "h1", "eth0", "ext4", 100.0 * i),
                 (i, ts, "rx_bytes_total", "h1", "lo", "ext4", 5.0 * i),
                 (i, ts, "fs_size", "h1", None, "tmpfs", 10.0),
                 (i, ts, "fs_size", "h1", None, "ext4", 50.0),
                 (i, ts, "fs_avail", "h1", None, "ext4", 20.0)]
    return spark.createDataFrame(rows, "sample_id long, ts timestamp_ntz, metric string, instance string, "
                                       "device string, fstype string, value double")


def test_label_selectors(spark):
    m = _metrics(spark)
    assert {r.device for r in mt.select(m, "rx_bytes_total", device="!lo").collect()} == {"eth0"}
    assert mt.select(m, "fs_size", fstype="!tmpfs").count() == 8
    assert mt.select(m, "fs_size", device="").count() == 16          # missing label matches ''


def test_counter_rate_and_reset(spark):
    rows = [(i, T0 + timedelta(seconds=15 * i), "c", "h", "", v) for i, v in
            enumerate([0.0, 30.0, 60.0, 15.0, 45.0, 75.0])]            # reset at i=3
    df = spark.createDataFrame(rows, "sample_id long, ts timestamp_ntz, metric string, instance string, "
                                     "mode string, value double")
    got = {r.sample_id: r.rate for r in mt.counter_rate(df).collect()}
    assert got[0] is None
    assert abs(got[1] - 2.0) < 1e-12
    assert abs(got[4] - (30.0 + 30.0 + 15.0 + 30.0) / 60.0) < 1e-12   # reset counts the new value (15)
    assert abs(got[5] - (30.0 + 15.0 + 30.0 + 30.0) / 60.0) < 1e-12   # frame 15..75 s: steps after the first


def test_filesystem_used(spark):
    m = mt.select(_metrics(spark), fstype="!tmpfs")
    d = mt.metric_difference(m, "fs_size", "fs_avail")
    assert {r.value for r in d.collect()} == {30.0}
    r = mt.metric_ratio(m, "fs_size", "fs_avail")
    assert {x.value for x in r.collect()} == {0.6}


def test_dynamic_vibration_option(spark):
    rd = spark.createDataFrame([(1, T0, "imu_01_c", "cluster_01", "imu", 0.0, 0.0, 0.0, 0.0, -9.81, 5.66,
                                 None, None, None, None, None)],
                               "event_id long, event_time timestamp_ntz, sensor_id string, cluster_id string, "
                               "sensor_type string, vx double, vy double, acc_x double, acc_y double, acc_z double, "
                               "acc_rms double, intensity double, pore_pressure double, latitude double, "
                               "longitude double, water_level double")
    assert rs.readings_features(rd).first().acc_rms == 5.66
    assert rs.readings_features(rd, dynamic=True).first().acc_rms == 0.0


def test_threshold_band_direction(spark):
    df = spark.createDataFrame([(5.0,), (10.0,), (50.0,), (None,)], "inv double")
    up = [r.b for r in df.select(pn.threshold_band("inv", pn.INVERSE_VELOCITY_STEPS).alias("b")).collect()]
    danger = ("green", ((10.0, "red"), (20.0, "yellow")))
    down = [r.b for r in df.select(pn.threshold_band("inv", danger, direction="down").alias("b")).collect()]
    assert up == ["green", "red", "red", None]          # the dashboard's colouring (red at >= 10)
    assert down == ["red", "yellow", "green", None]     # the alert rule's sense (danger below 10)


def _long(spark):
    rows = [(T0 + timedelta(milliseconds=500 * i), "c1", "inv_velocity", float(i)) for i in range(10)]
    rows += [(T0 + timedelta(days=40), "c2", "inv_velocity", 99.0)]
    return spark.createDataFrame(rows, "time timestamp_ntz, cluster_id string, field string, value double")


def test_aggregate_window_labels(spark):
    long = _long(spark).where("cluster_id = 'c1'")
    stop = {str(r.time): r.value for r in se.aggregate_window(long, "1 second").collect()}
    start = {str(r.time): r.value for r in se.aggregate_window(long, "1 second", label="start").collect()}
    assert stop["2024-01-01 00:00:01"] == 0.5 and start["2024-01-01 00:00:00"] == 0.5
    assert se.aggregate_window(long, "1 second", fn="max").where("value = 9.0").count() == 1


def test_time_range_latest_and_tags(spark):
    long = _long(spark)
    assert [r.cluster_id for r in se.tag_values(long, since="30 days").collect()] == ["c2"]
    assert sorted(r.cluster_id for r in se.tag_values(long, since="60 days").collect()) == ["c1", "c2"]
    from pyspark.sql import functions as F
    as_of = F.lit(T0 + timedelta(seconds=3)).cast("timestamp_ntz")
    recent = se.time_range(long, "2 seconds", as_of=as_of)
    assert sorted(r.value for r in recent.collect()) == [2.0, 3.0, 4.0, 5.0, 6.0]
    last = {r.cluster_id: (r.value, str(r.time)) for r in se.latest(long).collect()}
    assert last["c1"] == (9.0, "2024-01-01 00:00:04.500000") and last["c2"][0] == 99.0


def test_instant_select_and_count(spark):
    rows = [(T0 + timedelta(seconds=s), "m", h, "", v) for s, h, v in
            [(0, "h1", 1.0), (100, "h1", 2.0), (400, "h2", 3.0), (500, "h1", 4.0)]]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, metric string, instance string, mode string, value double")
    got = {r.instance: r.value for r in mt.instant_select(df).collect()}
    assert got == {"h1": 4.0, "h2": 3.0}                    # 5-minute lookback from the newest sample
    c = mt.count_series(df).first()
    assert c.n == 2 and str(c.as_of) == "2024-01-01 00:08:20"


def test_range_eval_at_common_instants(spark):
    from datetime import datetime, timedelta

    from scarp.operators import metrics as mt
    t0 = datetime(2024, 1, 1)
    a = [(k, t0 + timedelta(seconds=7 * k), "m", "a", None, float(k)) for k in range(20)]
    b = [(100 + k, t0 + timedelta(seconds=11 * k + 3), "m", "b", "", float(-k)) for k in range(5)]
    df = spark.createDataFrame(a + b, "sample_id long, ts timestamp_ntz, metric string, instance string, mode string, value double")
    got = {(r.instance, (r.ts - t0).seconds): r.value for r in mt.range_eval(df, "15 seconds", lookback="30 seconds").collect()}
    want = {}
    for name, rows in (("a", a), ("b", b)):
        for s in range(0, 150, 15):
            seen = [(r[1], r[5]) for r in rows if 0 <= (t0 + timedelta(seconds=s) - r[1]).total_seconds() <= 30]
            if seen and s <= 135:
                want[name, s] = max(seen)[1]
    assert got == want


def test_select_points_by_field_and_tag(spark):
    from scarp.operators import series as se
    df = spark.createDataFrame([(1, "c1", "x", 1.0), (1, "c2", "x", 2.0), (1, "c1", "y", 3.0)], "time int, cluster_id string, field string, value double")
    assert [r.value for r in se.select_points(df, ["x"], cluster_id="c1").collect()] == [1.0]
    assert se.select_points(df, cluster_id=["c1", "c2"]).count() == 3
