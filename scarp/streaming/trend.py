"""Failure time as the alerts arrive: the trailing trend of inverse velocity, by chained stateful aggregations.

The alert windows of a stream (append mode) are the rows; each is dealt to the trailing frames that hold it, a hopping
window of one frame and one step that ends with the row it belongs to. The regression of a frame is a mergeable
aggregate (count, means and central moments of at most one row per step), so a frame is never gathered: map tasks send
partial moments, the state holds one buffer per open frame and series. A frame is final with its last row, when the
watermark passes that row's window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.failure import MIN_FALLING_SLOPE
from ..operators.sequence import duration_us


def time_to_failure_stream(alerts: DataFrame, keys: Sequence[str] = ("cluster_id",), frame: str = "60 seconds",
                           every: str = "1 second", value_col: str = "inv_velocity",
                           min_slope: float = MIN_FALLING_SLOPE) -> DataFrame:
    """``window_start, keys, value, slope, ttf_seconds`` per alert window: the stream form of ``failure.time_to_failure``.

    ``alerts`` has a ``window`` column of ``every`` (``jobs.alert_stream``). Both borders of the frame count, as in the
    batch form: rows whose windows start from ``frame`` before the row's own on.
    """
    keys = list(keys)
    reach, step = duration_us(frame), duration_us(every)
    if reach % step:
        raise ValueError("the frame must be a multiple of the alert windows")
    rows = alerts.select(*keys, F.col(value_col).alias("_y"), F.col("window.start").alias("_start"), F.window_time("window").alias("_t"))
    framed = rows.select(*keys, "_y", "_start", F.window("_t", f"{reach + step} microseconds", every).alias("frame"))
    # seconds since the frame began: small numbers, whatever the date
    x = (F.unix_micros("_start") - F.unix_micros("frame.start")) / 1e6
    fits = framed.select(*keys, "_y", "_start", "frame", x.alias("_x")).groupBy("frame", *keys).agg(
        F.max("_start").alias("window_start"), F.max_by("_y", "_start").alias(value_col),
        F.regr_slope("_y", "_x").alias("slope"), F.regr_avgx("_y", "_x").alias("_mx"), F.regr_avgy("_y", "_x").alias("_my"))
    # a frame belongs to the row that ends it; without such a row there is nothing to report
    own = fits.where(F.unix_micros(F.col("frame.end")) - F.unix_micros("window_start") == F.lit(step))
    fitted_now = F.col("_my") + F.col("slope") * (F.lit(reach / 1e6) - F.col("_mx"))
    return own.select("window_start", *keys, value_col, "slope",
                      F.when(F.col("slope") < -F.lit(min_slope), -fitted_now / F.col("slope")).alias("ttf_seconds"))
