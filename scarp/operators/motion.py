"""Rain accumulation, damped motion integration, GNSS displacement and
forward fill, as bucketed per-series table jobs (see ``sequence``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import features as fx
from ..session import materialize
from . import sequence as sq
from .resample import epoch_micros, order_key

# Fixed value: velocity damping per IMU step.
DAMPING = 0.95


def with_dt(df: DataFrame, keys: Sequence[str], time_col: str = "event_time", tie_col: str | None = "event_id",
            width: str | int = "120 seconds", out: str = "dt") -> DataFrame:
    """Seconds since the previous reading of the series; 0 for the first one."""
    d = df.withColumn("_us", epoch_micros(df, time_col))
    p = sq.with_previous(d, keys, ["_us"], time_col, tie_col, width)
    return p.select(*df.columns, (F.coalesce(F.col("_us") - F.col("prev__us"), F.lit(0)) / 1e6).alias(out))


def rain_accumulation(rain: DataFrame, keys: Sequence[str] = ("sensor_id",), reset: str | None = None,
                      time_col: str = "event_time", tie_col: str | None = "event_id",
                      width: str | int = "120 seconds", max_rows: int | None = sq.MAX_BUCKET_ROWS,
                      checkpoint: bool = True) -> DataFrame:
    """Running rainfall in mm: sum of intensity/3600 * dt (mm/h over seconds).

    ``reset`` (e.g. '60 seconds') restarts the total, and the first dt, every
    period of event time; the period becomes part of the series key.
    ``checkpoint`` materializes the rows with their dt once (shared folder),
    as both the running sum and its bucket carries read them.
    """
    keys = list(keys)
    d = rain
    if reset:
        d = d.withColumn("period", F.window(time_col, reset).start)
        keys = keys + ["period"]
    d, _ = sq.assign_buckets(d, keys, time_col, tie_col, width, max_rows)
    d = with_dt(d, keys, time_col, tie_col, width)
    d = d.withColumn("_inc", F.col("intensity") / 3600.0 * F.col("dt"))
    if checkpoint:
        d = materialize(d)
    return sq.running_sum(d, keys, "_inc", "accumulated", time_col, tie_col, width).drop("_inc", "_bucket")


def integrate_damped(imu: DataFrame, keys: Sequence[str] = ("sensor_id",), damping: float = DAMPING,
                     base=fx.BASE_ACCELERATION, time_col: str = "event_time", tie_col: str | None = "event_id",
                     width: str | int = "120 seconds", max_rows: int | None = sq.MAX_BUCKET_ROWS,
                     checkpoint: bool = True) -> DataFrame:
    """Velocity and displacement per axis from acceleration.

    v_n = damping * (v_(n-1) + a_dyn * dt_n) ; d_n = d_(n-1) + v_n * dt_n,
    with a_dyn the acceleration minus the resting vector. A linear recurrence,
    solved by the bucketed scan (no per-sensor loop). ``checkpoint`` writes
    the intermediates that feed several branches once to the shared folder.
    """
    keys = list(keys)
    d, buckets = sq.assign_buckets(imu, keys, time_col, tie_col, width, max_rows)
    d = with_dt(d, keys, time_col, tie_col, width)
    if checkpoint:
        d = materialize(d)
    dx, dy, dz = fx.dynamic_acceleration("acc_x", "acc_y", "acc_z", base)
    lam = F.lit(float(damping))
    v = sq.linear_scan(d, keys, lam, [lam * a * F.col("dt") for a in (dx, dy, dz)], ["vel_x", "vel_y", "vel_z"],
                       time_col, tie_col, width, buckets=buckets, checkpoint=checkpoint)
    steps = v.select("*", *[(F.col(f"vel_{ax}") * F.col("dt")).alias(f"_s{ax}") for ax in "xyz"])
    if checkpoint:
        steps = materialize(steps)
    out = sq.running_sum(steps, keys, [f"_s{ax}" for ax in "xyz"], [f"disp_{ax}" for ax in "xyz"],
                         time_col, tie_col, width)
    return out.drop("_sx", "_sy", "_sz", "_bucket")


def gnss_positions(gnss: DataFrame) -> DataFrame:
    x, y = fx.planar_xy("latitude", "longitude")
    return gnss.select("*", fx.packet_round(x, "vn2000").alias("x"), fx.packet_round(y, "vn2000").alias("y"))


def gnss_displacement(pos: DataFrame, keys: Sequence[str] = ("sensor_id",), time_col: str = "event_time",
                      tie_col: str | None = "event_id", width: str | int = "120 seconds",
                      max_rows: int | None = sq.MAX_BUCKET_ROWS) -> DataFrame:
    """Planar movement against the series' first fix, and the step from the previous fix.

    The baseline is an aggregate (partial aggregation makes hot series cheap);
    its table has one row per series and is joined back by key.
    """
    keys = list(keys)
    ok = order_key(pos, time_col, tie_col)
    series = F.struct(*keys).alias("_sk")  # NULL members compare as equal: no row is lost
    base = pos.groupBy(series).agg(F.min_by("x", ok).alias("x0"), F.min_by("y", ok).alias("y0"))
    p, _ = sq.assign_buckets(pos, keys, time_col, tie_col, width, max_rows)
    p = sq.with_previous(p, keys, ["x", "y"], time_col, tie_col, width)
    j = p.withColumn("_sk", F.struct(*keys)).join(base, "_sk")
    ddx, ddy = F.col("x") - F.col("x0"), F.col("y") - F.col("y0")
    sx, sy = F.col("x") - F.col("prev_x"), F.col("y") - F.col("prev_y")
    return j.select(*pos.columns, ddx.alias("dx"), ddy.alias("dy"), F.sqrt(ddx * ddx + ddy * ddy).alias("displacement"),
                    F.sqrt(sx * sx + sy * sy).alias("step"))
