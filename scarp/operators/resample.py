"""Event-time resampling: tumbling / hopping windows with algebraic aggregates.

All aggregates used here keep fixed-width buffers, so Spark plans a partial
HashAggregate before the shuffle: each map task sends at most one row per
(window, key) however hot a cluster is, and the exchange is bounded by the
number of windows, not by the number of readings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import features as fx

# The tie-break id is packed below the microseconds: 10^19 leaves room for any
# non-negative 64-bit id, and micros * 10^19 stays far inside DECIMAL(38,0).
_TIE_SCALE = 10_000_000_000_000_000_000


def epoch_micros(df: DataFrame, time_col: str) -> Column:
    """Microseconds since 1970 for TIMESTAMP and TIMESTAMP_NTZ alike.

    For NTZ the wall-clock difference is taken as an interval: unlike
    ``timestampdiff`` (which goes through the session zone and jumps at DST
    changes) it is zone-free and monotone.
    """
    dtype = df.schema[time_col].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return F.expr(f"CAST(CAST(CAST((`{time_col}` - TIMESTAMP_NTZ'1970-01-01 00:00:00') AS INTERVAL SECOND)"
                      f" AS DECIMAL(18,6)) * 1000000 AS BIGINT)")
    return F.unix_micros(F.col(time_col))


def order_key(df: DataFrame, time_col: str, tie_col: str | None) -> Column:
    """Total order on (event time, tie id) as one DECIMAL(38,0).

    A numeric key keeps ``max_by`` on a mutable fixed-width buffer (hash
    aggregation); a struct key would force a sort-based aggregate.
    """
    micros = epoch_micros(df, time_col).cast("decimal(38,0)")
    if tie_col is None:
        return micros
    # a missing id ranks as 0: the row still has its place in time
    tie = F.coalesce(F.col(tie_col).cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))
    return micros * F.lit(str(_TIE_SCALE)).cast("decimal(38,0)") + tie


def last_by_time(df: DataFrame, value_col: str, time_col: str = "event_time",
                 tie_col: str | None = "event_id") -> Column:
    """Newest non-null value by event time (ties by id): a deterministic ``last(ignorenulls)``.

    The reference takes the last value in arrival order, which changes with
    delivery order; event-time order gives the same answer on every replay.
    """
    v = F.col(value_col)
    return F.max_by(v, F.when(v.isNotNull(), order_key(df, time_col, tie_col)))


def exact_mean(col, digits: int = 6, scale: int = 9) -> Column:
    """Mean over a fixed-point copy of the values, rounded half-up to ``digits``.

    Order-independent (no floating sum), so every engine and every partitioning
    gives the same digits; precision 18 keeps Spark on its long-backed decimals.
    Values must lie within +-1e9 (DECIMAL(18,9)); larger ones raise an error
    under ANSI mode rather than give a wrong mean.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.round(F.avg(c.cast(f"decimal(18,{scale})")), digits).cast("double")


def readings_features(readings: DataFrame, dynamic: bool = False) -> DataFrame:
    """Flat feature rows from derived readings (GNSS position projected and packet-rounded).

    ``dynamic=True`` takes vibration as the RMS of the acceleration with the
    resting (gravity) vector removed, instead of the packet's RMS, which
    includes gravity and so always exceeds the vibration threshold.
    """
    x, y = fx.planar_xy("latitude", "longitude")
    vib = F.col("acc_rms")
    if dynamic:
        vib = F.when(F.col("sensor_type") == "imu", fx.rms(*fx.dynamic_acceleration("acc_x", "acc_y", "acc_z")))
    return readings.select(
        "event_id", "event_time", "sensor_id", "cluster_id", "sensor_type",
        F.when(F.col("sensor_type") == "imu", fx.speed_xy("vx", "vy")).alias("imu_velocity"),
        vib.alias("acc_rms"),
        F.col("intensity").alias("rain"),
        F.col("pore_pressure").alias("pressure"),
        fx.packet_round(x, "vn2000").alias("gnss_x"),
        fx.packet_round(y, "vn2000").alias("gnss_y"),
    )


def monitoring_aggs(df: DataFrame, time_col: str = "event_time",
                    tie_col: str | None = "event_id") -> list[Column]:
    return [
        F.avg("imu_velocity").alias("avg_velocity"),
        F.max("acc_rms").alias("max_vibration"),
        last_by_time(df, "gnss_x", time_col, tie_col).alias("last_gnss_x"),
        last_by_time(df, "gnss_y", time_col, tie_col).alias("last_gnss_y"),
        F.max("rain").alias("rain_intensity"),
        F.max("pressure").alias("pore_pressure"),
        # no IMU reading means inverse velocity falls back to its default (NORMAL): flag it
        (F.count("imu_velocity") > 0).alias("has_imu"),
    ]


def core_aggs(df: DataFrame, time_col: str = "event_time",
              tie_col: str | None = "event_id") -> list[Column]:
    return [
        F.avg("imu_velocity").alias("avg_velocity"),
        F.max("acc_rms").alias("max_vibration"),
        last_by_time(df, "gnss_x", time_col, tie_col).alias("last_gnss_x"),
        F.max("rain").alias("rain_intensity"),
        F.max("pressure").alias("pore_pressure"),
    ]


def resample(df: DataFrame, aggs: Sequence[Column], every: str = "1 second",
             slide: str | None = None, keys: Sequence[str] = ("cluster_id",),
             time_col: str = "event_time", watermark: str | None = None) -> DataFrame:
    """Group readings into event-time windows (tumbling, or hopping with ``slide``).

    ``keys=()`` is the reference core job's global window; the per-cluster
    form is the default because it spreads windows over many keys.
    ``watermark`` is applied for streaming inputs (late rows are dropped).
    """
    if watermark is not None:
        df = df.withWatermark(time_col, watermark)
    win = F.window(time_col, every, slide) if slide else F.window(time_col, every)
    return df.groupBy(win.alias("window"), *keys).agg(*aggs)


def environment_summary(readings: DataFrame, every: str = "10 seconds", exact: bool = False) -> DataFrame:
    """Windowed environment summary: mean vertical acceleration, peak rain and
    water level, and the newest GNSS longitude (global window).
    ``exact`` takes the fixed-point mean (6 digits) instead of a double mean."""
    return resample(readings, [
        (exact_mean("acc_z") if exact else F.avg("acc_z")).alias("avg_acc_z"),
        F.max("intensity").alias("max_rain"),
        F.max("water_level").alias("max_water_level"),
        last_by_time(readings, "longitude").alias("last_gnss"),
    ], every=every, keys=())
