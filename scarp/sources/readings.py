"""Sensor readings and host metrics derived from the driver table ``events``.

``events`` covers 30 days with one row every few minutes; event time is
compressed 3600x so that it lands on the 1-second windows the alert model
uses. The mapping is fixed so both Spark and the DuckDB oracle derive the
very same rows (see FIXTURES.md). Everything here is a per-row projection
(no shuffle) except the counter in ``host_metrics``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the derivation (must equal the oracle's).
EPOCH = "2024-01-01 00:00:00"
TIME_COMPRESSION = 3600
EVENT_TO_SENSOR = {"click": "imu", "view": "gnss", "purchase": "rain", "signup": "groundwater"}
CLUSTERS = 3
HOSTS = 5
COUNTER_RESET_US = 120_000_000


def _only(sensor: str, expr: Column) -> Column:
    return F.when(F.col("sensor_type") == sensor, expr)


def readings(events: DataFrame, keep_raw: bool = False, sensor_types: Sequence[str] | None = None) -> DataFrame:
    """One flat row per reading: event time, sensor, cluster and the metric columns.

    ``keep_raw`` also passes ``user_id`` and the raw ``value`` through (as
    ``raw_value``) for derivations that need them, without a join back.
    ``sensor_types`` keeps only those sensors, filtering on the stored
    ``event_type`` so the predicate reaches the parquet scan (PushedFilters).
    """
    if sensor_types is not None:
        wanted = [ev for ev, st in EVENT_TO_SENSOR.items() if st in set(sensor_types)]
        events = events.where(F.col("event_type").isin(*wanted))
    sensor = F.lit("unknown")
    for ev, st in reversed(list(EVENT_TO_SENSOR.items())):
        sensor = F.when(F.col("event_type") == ev, F.lit(st)).otherwise(sensor)
    value, k = F.col("value"), F.col("k")
    e = events.select(
        "event_id", "event_type", "user_id", "value",
        F.get_json_object("props", "$.k").cast("double").alias("k"),
        F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'{EPOCH}', ts) DIV {TIME_COMPRESSION}").alias("us"),
    )
    t = e.select(
        "*",
        F.expr(f"TIMESTAMP_NTZ'{EPOCH}' + make_dt_interval(0, 0, 0, CAST(us AS DECIMAL(18,6)) / 1000000)")
        .alias("event_time"),
        sensor.alias("sensor_type"),
        F.concat(F.lit("cluster_0"), (F.col("user_id") % CLUSTERS + 1).cast("string")).alias("cluster_id"),
    )
    raw = [F.col("user_id"), F.col("value").alias("raw_value")] if keep_raw else []
    return t.select(
        "event_id", "us", "event_time", "sensor_type", "cluster_id",
        F.concat("sensor_type", F.lit("_01_"), "cluster_id").alias("sensor_id"),
        _only("imu", value / 1000.0).alias("vx"),
        _only("imu", k / 1000.0).alias("vy"),
        _only("imu", (k - 50.0) / 500.0).alias("acc_x"),
        _only("imu", (value - 50.0) / 1000.0).alias("acc_y"),
        _only("imu", (k - 50.0) / 1000.0 - 9.81).alias("acc_z"),
        _only("imu", value / 200.0).alias("acc_rms"),
        _only("rain", value).alias("intensity"),
        _only("groundwater", 2.4 + k / 500.0).alias("water_level"),
        _only("groundwater", 9.81 * (2.4 + k / 500.0) + (value - 50.0) / 100.0).alias("pore_pressure"),
        _only("gnss", 21.0285 + (value - 50.0) / 10000000.0).alias("latitude"),
        _only("gnss", 105.8542 + (k - 50.0) / 10000000.0).alias("longitude"),
        *raw,
    )


def host_metrics(events: DataFrame) -> DataFrame:
    """Long label-set metrics ``(sample_id, ts, metric, instance, mode, value)``.

    ``cpu_seconds_total`` is a counter per (instance, mode) that resets every
    120 s of event time; the running sum is partitioned by the reset period,
    so no window partition outgrows one period of one label set.
    """
    # readings() is a projection of events, so the raw columns ride along: no join.
    j = (readings(events, keep_raw=True, sensor_types=("imu", "gnss"))
         .select("event_id", "us", "event_time", "sensor_type", "vy", "user_id",
                 F.col("raw_value").alias("value")))
    instance = F.concat(F.lit("host_"), (F.col("user_id") % HOSTS).cast("string"))
    mode = F.when(F.col("vy") < 0.05, "idle").otherwise("user")
    period = F.floor(F.col("us") / COUNTER_RESET_US).cast("long")
    imu = j.where(F.col("sensor_type") == "imu").select(
        "event_id", "event_time", "value", instance.alias("instance"), mode.alias("mode"),
        period.alias("period"))
    w = (Window.partitionBy("instance", "mode", "period").orderBy("event_time", "event_id")
         .rowsBetween(Window.unboundedPreceding, 0))
    cpu = imu.select(
        F.col("event_id").alias("sample_id"), F.col("event_time").alias("ts"), F.lit("cpu_seconds_total").alias("metric"), "instance", "mode",
        F.sum(F.col("value").cast("decimal(18,2)")).over(w).cast("double").alias("value"))
    gnss = j.where(F.col("sensor_type") == "gnss").select(
        F.col("event_id").alias("sample_id"), F.col("event_time").alias("ts"), instance.alias("instance"), F.col("value"))
    mem = gnss.select(
        "sample_id", "ts", F.inline(F.array(
            F.struct(F.lit("memory_total").alias("metric"), F.lit(1000.0).alias("value")),
            F.struct(F.lit("memory_available").alias("metric"), F.col("value").alias("value")))),
        "instance").select("sample_id", "ts", "metric", "instance", F.lit("").alias("mode"), "value")
    return cpu.unionByName(mem)
