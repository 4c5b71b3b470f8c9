"""Fixed schemas: the sensor envelope, the reference's parsed subset, points."""

from __future__ import annotations

from pyspark.sql import types as T

D = T.DoubleType()
S = T.StringType()


def _xyz(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, D, True) for n in names])


# Superset of every packet field the four sensor types publish.
VALUE_SCHEMA = T.StructType([
    T.StructField("velocity", _xyz("x", "y", "z"), True),
    T.StructField("acceleration", _xyz("x", "y", "z", "rms"), True),
    T.StructField("angular_velocity", _xyz("x", "y", "z"), True),
    T.StructField("tilt", _xyz("roll", "pitch", "yaw"), True),
    T.StructField("displacement", _xyz("x", "y", "z"), True),
    T.StructField("intensity", D, True),
    T.StructField("accumulated", D, True),
    T.StructField("water_level", D, True),
    T.StructField("pore_pressure", D, True),
    T.StructField("latitude", D, True),
    T.StructField("longitude", D, True),
    T.StructField("vn2000", _xyz("x", "y", "z"), True),
])

ENVELOPE_SCHEMA = T.StructType([
    T.StructField("timestamp", S, True),
    T.StructField("cluster_id", S, True),
    T.StructField("sensor_id", S, True),
    T.StructField("sensor_type", S, True),
    T.StructField("mqtt_topic", S, True),
    T.StructField("value", VALUE_SCHEMA, True),
    T.StructField("unit", T.MapType(S, S), True),
])

# The subset the reference jobs declare; anything else in a packet is dropped.
REFERENCE_SCHEMA = T.StructType([
    T.StructField("timestamp", S, True),
    T.StructField("sensor_id", S, True),
    T.StructField("sensor_type", S, True),
    T.StructField("value", T.StructType([
        T.StructField("velocity", _xyz("x", "y", "z"), True),
        T.StructField("acceleration", _xyz("rms"), True),
        T.StructField("intensity", D, True),
        T.StructField("pore_pressure", D, True),
        T.StructField("vn2000", _xyz("x", "y"), True),
    ]), True),
])

SENSOR_TYPES = ("imu", "gnss", "rain", "groundwater")

# Point layout of the time-series sink: tag, then fields.
MEASUREMENT = "landslide_metrics"
POINT_TAG = "cluster_id"
POINT_FIELDS = ("inv_velocity", "avg_velocity", "max_vibration", "rain_intensity",
                "pore_pressure", "gnss_x", "gnss_y", "alert_level")
