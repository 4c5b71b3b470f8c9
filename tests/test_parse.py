"""Envelope parsing, malformed messages, cluster and topic helpers."""

import json

from pyspark.sql import functions as F

from scarp.functions import parse as ps
from scarp.functions import features as fx

# Example packets, one per sensor type, in the published packet layout.
RAIN = {"timestamp": "2024-03-02T08:15:30.250000", "cluster_id": "cluster_07", "sensor_id": "rain_01_cluster_07",
        "sensor_type": "rain", "value": {"intensity": 62.4, "accumulated": 3.1},
        "unit": {"intensity": "mm/h", "accumulated": "mm"}}
WATER = {"timestamp": "2024-03-02T08:15:30", "cluster_id": "cluster_07", "sensor_id": "groundwater_01_cluster_07",
         "sensor_type": "groundwater", "value": {"water_level": 2.512, "pore_pressure": 24.71}}
IMU = {"timestamp": "2024-03-02T08:15:30.5", "cluster_id": "cluster_07", "sensor_id": "imu_01_cluster_07",
       "sensor_type": "imu",
       "value": {"acceleration": {"x": 0.0123, "y": -0.0456, "z": -9.8011, "rms": 5.6588},
                 "angular_velocity": {"x": 0.001, "y": 0.002, "z": -0.003},
                 "tilt": {"roll": -179.73, "pitch": 0.07, "yaw": 0.4},
                 "velocity": {"x": 0.3, "y": 0.4, "z": 0.01},
                 "displacement": {"x": 0.000123, "y": 0.0, "z": -0.000001}}}
GNSS = {"timestamp": "2024-03-02T08:15:31.000001", "cluster_id": "cluster_07", "sensor_id": "gnss_01_cluster_07",
        "sensor_type": "gnss", "value": {"latitude": 21.02851234, "longitude": 105.85423456,
                                         "vn2000": {"x": 2341085.123, "y": 588797.456, "z": 10.2}}}


def _msgs(spark, texts):
    return spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "key string, value string")


def test_packets_parse_to_features(spark):
    df = _msgs(spark, [json.dumps(p) for p in (RAIN, WATER, IMU, GNSS)])
    f = ps.envelope_features(ps.parse_json(df, keep=("key",)), keep=("key",))
    rows = {r.key: r for r in f.collect()}
    assert rows["0"].rain == 62.4 and rows["0"].imu_velocity is None
    assert rows["1"].pressure == 24.71
    assert abs(rows["2"].imu_velocity - 0.5) < 1e-12 and rows["2"].acc_rms == 5.6588
    assert rows["3"].gnss_x == 2341085.123 and rows["3"].gnss_y == 588797.456
    assert all(r.cluster_id == "cluster_07" for r in rows.values())
    assert str(rows["3"].event_time) == "2024-03-02 08:15:31.000001"
    assert str(rows["1"].event_time) == "2024-03-02 08:15:30"


def test_malformed_messages_are_tagged(spark):
    bad_type = dict(RAIN, value={"intensity": "x"})
    extra = dict(RAIN, surprise=1)
    no_time = {k: v for k, v in RAIN.items() if k != "timestamp"}
    garbage_time = dict(RAIN, timestamp="yesterday")
    no_type = {k: v for k, v in RAIN.items() if k != "sensor_type"}
    texts = ["not json", json.dumps([RAIN, RAIN]), json.dumps(bad_type), json.dumps(extra),
             json.dumps(no_time), json.dumps(garbage_time), json.dumps(no_type), None]
    tagged = ps.tag_messages(_msgs(spark, texts), keep=("key",))
    reasons = {r.key: r.reason for r in tagged.select("key", "reason").collect()}
    assert reasons["0"] == "unparseable"
    assert reasons["1"] == "unparseable"       # an array of objects is not one envelope
    assert reasons["2"] is None                # only the mistyped field is NULL
    assert reasons["3"] is None                # unknown fields are ignored
    assert reasons["4"] == "missing_time"
    assert reasons["5"] == "missing_time"
    assert reasons["6"] == "missing_type"
    assert reasons["7"] == "unparseable"
    good, rejected = ps.split_rejected(_msgs(spark, texts), keep=("key",))
    assert good.count() == 2 and rejected.count() == 6
    assert good.where("key = '2'").first().rain is None


def test_cluster_of_sensor_id(spark):
    ids = ["imu_01_cluster_01", "imu_cluster_01_001", "imu_01_cluster_A", "imu_01_site_north", None]
    df = spark.createDataFrame([(i,) for i in ids], "sid string")
    got = df.select(ps.cluster_of("sid").alias("c"),
                    ps.resolve_cluster(F.lit(None).cast("string"), "sid").alias("r"),
                    ps.resolve_cluster(F.lit("site_north"), "sid").alias("p")).collect()
    assert [r.c for r in got] == ["cluster_01", "cluster_01", "", "", None]
    assert [r.r for r in got] == ["cluster_01", "cluster_01", "unknown", "unknown", "unknown"]
    assert all(r.p == "site_north" for r in got)


def test_topic_roundtrip(spark):
    df = spark.createDataFrame([("cluster_A", "rain")], "c string, t string")
    r = df.select(ps.topic("c", "t").alias("tp")).select(
        "tp", ps.topic_cluster("tp").alias("c"), ps.topic_sensor_type("tp").alias("t")).first()
    assert (r.tp, r.c, r.t) == ("sensors/cluster_A/rain", "cluster_A", "rain")


def test_physics_helpers(spark):
    df = spark.createDataFrame([(0.0, 0.0, -9.81, 2.0, 21.0, 105.0)], "ax double, ay double, az double, h double, "
                                                                     "lat double, lon double")
    roll, pitch = fx.tilt("ax", "ay", "az")
    x, y = fx.planar_xy("lat", "lon")
    r = df.select(fx.rms("ax", "ay", "az").alias("rms"), roll.alias("roll"), pitch.alias("pitch"),
                  fx.hydrostatic_pressure("h").alias("p"), x.alias("x"), y.alias("y"),
                  fx.non_negative(F.lit(-3.0)).alias("c")).first()
    assert abs(r.rms - 9.81 / 3 ** 0.5) < 1e-12
    assert abs(abs(r.roll) - 180.0) < 1e-9 and abs(r.pitch) < 1e-12
    assert abs(r.p - 19.62) < 1e-12
    assert abs(r.x - 21.0 * 3.141592653589793 / 180 * 6378137.0) < 1e-6 and r.y == 500000.0
    assert r.c == 0.0


def test_add_and_split_topic(spark):
    df = spark.createDataFrame([("cluster_02", "gnss")], "cluster_id string, sensor_type string")
    r = ps.split_topic(ps.add_topic(df)).first()
    assert (r.mqtt_topic, r.topic_cluster, r.topic_type) == ("sensors/cluster_02/gnss", "cluster_02", "gnss")


def test_sink_defaults(spark):
    from scarp.functions import panels as pn
    df = spark.createDataFrame([("", None, 2.0), (None, 1.0, None)], "cluster_id string, a double, b double")
    got = pn.sink_defaults(df, fields=["a", "b"]).collect()
    assert [(r.cluster_id, r.a, r.b) for r in got] == [("unknown", 0.0, 2.0), ("unknown", 1.0, 0.0)]


def test_envelope_sink_roundtrip(spark, tmpdir_local):
    import os
    from scarp.plans import catalog
    from scarp.sources import envelopes as ev
    r = catalog.load_readings(spark, "/root/testdata/sf0.001", "gnss", "rain")
    path = os.path.join(tmpdir_local, "env")
    ev.write_envelopes(ev.encode_envelopes(r), "text", path=path)
    back = ev.read_envelopes(spark, "text", path=path, stream=False)
    parsed = ps.parse_json(back)
    assert parsed.count() == r.count()
    assert parsed.where("sensor_type = 'gnss' AND value.vn2000.x IS NOT NULL").count() == \
        r.where("sensor_type = 'gnss'").count()
    topics = {row.mqtt_topic.split("/")[0] for row in parsed.select("mqtt_topic").distinct().collect()}
    assert topics == {"sensors"}


def test_reference_subset_schema_drops_other_fields(spark):
    from scarp.schema import REFERENCE_SCHEMA
    df = _msgs(spark, [json.dumps(IMU), json.dumps(GNSS)])
    p = ps.parse_json(df, schema=REFERENCE_SCHEMA)
    assert "cluster_id" not in p.columns and "unit" not in p.columns
    rows = p.collect()
    assert rows[0].value.velocity.x == 0.3 and rows[0].value.acceleration.rms == 5.6588
    assert rows[1].value.vn2000.x == 2341085.123
    assert "tilt" not in rows[0].value.asDict()


def test_drift_reports_what_the_schema_does_not_know(spark):

    good = '{"timestamp":"2024-01-01T00:00:00.5","sensor_id":"rain_01_cluster_01","sensor_type":"rain","value":{"intensity":1.5}}'
    odd = ('{"timestamp":"2024-01-01T00:00:01","sensor_id":7,"sensor_type":"rain","firmware":null,"value":'
           '{"intensity":"2.5","velocity":{"x":1,"w":[1,2]},"tilt":3,"battery":{"level":0.5}}}')
    rows = spark.createDataFrame([(1, good), (2, odd), (3, "[1]"), (4, None), (5, '{"value":{"x.y":true}}')], "key long, value string")
    tagged = ps.tag_messages(rows, keep=("key",), drift=True)
    got = {r.key: r for r in tagged.collect()}
    assert got[1].drift is None and got[1].reason is None and got[1].value.intensity == 1.5
    assert {(d.path, d.type, d.value) for d in got[2].drift} == {
        ("sensor_id", "NUMBER", "7"), ("firmware", "NULL", "null"), ("value.intensity", "STRING", '"2.5"'), ("value.velocity.w", "ARRAY", "[1,2]"),
        ("value.tilt", "NUMBER", "3"), ("value.battery", "OBJECT", '{"level":0.5}')}
    assert got[2].value.intensity == 2.5 and got[2].value.velocity.x == 1.0
    assert [got[k].reason for k in (3, 4, 5)] == ["unparseable", "unparseable", "missing_time"]
    assert [(d.path, d.type) for d in got[5].drift] == [("value.x.y", "BOOLEAN")]
    # one parse in the plan, however many columns are used
    plan = ps.envelope_features(tagged, keep=("drift", "reason")).where("reason IS NULL")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parsejson") == 1 and "from_json" not in plan, plan
    # both parses give the same rows for messages that keep to the schema
    same = rows.where("key <> 2 AND key <> 5")
    assert ps.tag_messages(same, keep=("key",)).collect() == ps.tag_messages(same, keep=("key",), drift=True).drop("drift").collect()

