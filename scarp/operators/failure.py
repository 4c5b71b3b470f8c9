"""Failure-time trend: fit inverse velocity against time over a trailing range."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import sequence as sq
from .resample import epoch_micros
from .sliding import frame_aggregate

# A trend must fall at least this fast (1/v per second) to predict a failure.
MIN_FALLING_SLOPE = 1e-9


def time_to_failure(df: DataFrame, keys: Sequence[str] = ("cluster_id",), frame: str = "60 seconds",
                    time_col: str = "window_start", value_col: str = "inv_velocity",
                    width: str | int = "120 seconds", min_slope: float = MIN_FALLING_SLOPE,
                    method: str = "blocks") -> DataFrame:
    """Least-squares line of ``value`` on time over the trailing ``frame`` at every row.

    When the line falls, ``ttf_seconds`` is how long until it reaches 0
    (Fukuzono: inverse velocity heading to zero means failure). Time enters
    the fit relative to the row's bucket, so the fit stays well conditioned.
    ``method="blocks"`` merges two running halves per frame (``sliding``):
    nothing is aggregated twice or subtracted, and a burst of rows inside one
    bucket is spread over many tasks. The other methods keep a bucket in one
    task: ``"frame"`` lets Spark aggregate each sliding frame anew, ``"prefix"``
    takes frame sums as prefix differences, equal up to about 1e-9 relative.
    """
    if method == "blocks":
        return _trend_of_blocks(df, keys, frame, time_col, value_col, min_slope)
    keys = list(keys)
    fu = sq.duration_us(frame)
    wu = sq.duration_us(width)
    ctx = sq.with_context(df, time_col, frame, width)
    ctx = ctx.withColumn("_us", epoch_micros(ctx, time_col))
    x = (F.col("_us") - F.col("_part") * F.lit(wu)) / 1e6
    y = F.col(value_col)
    ctx = ctx.withColumn("_x", x)
    if method == "prefix":
        # O(n): frame sums as differences of growing-frame prefix sums
        by_time = Window.partitionBy(*keys, "_part").orderBy("_us")
        upto = by_time.rangeBetween(Window.unboundedPreceding, 0)
        before = by_time.rangeBetween(Window.unboundedPreceding, -(fu + 1))
        has = y.isNotNull() & F.col("_x").isNotNull()

        def fsum(c):
            c = F.when(has, c)
            return F.sum(c).over(upto) - F.coalesce(F.sum(c).over(before), F.lit(0.0))

        n = F.count(F.when(has, 1)).over(upto) - F.count(F.when(has, 1)).over(before)
        sx, sy = fsum(F.col("_x")), fsum(y)
        sxy, sxx = fsum(F.col("_x") * y), fsum(F.col("_x") * F.col("_x"))
        den = n * sxx - sx * sx
        slope = F.when((n > 1) & (den > 0), (n * sxy - sx * sy) / den)
        fitted_now = sy / n + slope * (F.col("_x") - sx / n)
    else:
        w = Window.partitionBy(*keys, "_part").orderBy("_us").rangeBetween(-fu, 0)
        slope = F.regr_slope(y, "_x").over(w)
        fitted_now = F.regr_avgy(y, "_x").over(w) + slope * (F.col("_x") - F.regr_avgx(y, "_x").over(w))
    out = ctx.select(*df.columns, "_own", slope.alias("slope"),
                     F.when(slope < -F.lit(min_slope), -fitted_now / slope).alias("ttf_seconds"))
    return out.where("_own").drop("_own")


def _trend_of_blocks(df: DataFrame, keys: Sequence[str], frame: str, time_col: str, value_col: str, min_slope: float) -> DataFrame:
    """The trend from merged moments of the frame (count, sums of x, y, xy, xx about the row's cell)."""
    width = F.lit(sq.duration_us(frame))
    y = F.col(value_col)
    sums = {"_n": lambda x: F.when(y.isNotNull(), 1.0), "_sx": lambda x: F.when(y.isNotNull(), x), "_sy": lambda x: y,
            "_sxy": lambda x: x * y, "_sxx": lambda x: F.when(y.isNotNull(), x * x)}
    m = frame_aggregate(df, keys, frame, sums, time_col=time_col)
    us = epoch_micros(df, time_col)
    x = (us - F.floor(us / width).cast("long") * width) / 1e6
    n, sx, sy, sxy, sxx = (F.col(c) for c in sums)
    spread = n * sxx - sx * sx
    m = m.withColumn("slope", F.when((n > 1) & (spread > 0), (n * sxy - sx * sy) / spread))
    fitted_now = sy / n + F.col("slope") * (x - sx / n)
    return m.select(*df.columns, "slope", F.when(F.col("slope") < -F.lit(min_slope), -fitted_now / F.col("slope")).alias("ttf_seconds"))
