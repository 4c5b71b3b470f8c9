"""The two alert jobs of the system as DataFrame -> DataFrame plans.

Both are stateless chains around one resample, so they run unchanged on a
batch DataFrame and on a streaming one (with a watermark).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import model
from ..operators import resample as rs


def monitoring_alerts(features: DataFrame, every: str = "1 second",
                      keys: Sequence[str] = ("cluster_id",), watermark: str | None = None,
                      time_col: str = "event_time", tie_col: str | None = "event_id") -> DataFrame:
    """Per-cluster 1-s windows -> inverse velocity -> integer level and message."""
    agg = rs.resample(features, rs.monitoring_aggs(features, time_col, tie_col), every=every,
                      keys=keys, time_col=time_col, watermark=watermark)
    return (agg.select("*", model.inverse_velocity("avg_velocity").alias("inv_velocity"))
            .select("*", model.alert_level("inv_velocity", "rain_intensity", "max_vibration")
                    .alias("alert_level"))
            .select("*", model.alert_message("alert_level").alias("alert_message")))


def core_alerts(features: DataFrame, every: str = "1 second", slide: str | None = "1 second",
                watermark: str | None = None, time_col: str = "event_time",
                tie_col: str | None = "event_id") -> DataFrame:
    """Global windows (no key) -> inverse velocity -> text ladder (core job, before output casts)."""
    agg = rs.resample(features, rs.core_aggs(features, time_col, tie_col), every=every, slide=slide,
                      keys=(), time_col=time_col, watermark=watermark)
    return agg.select("*", model.inverse_velocity("avg_velocity").alias("inv_velocity")).select(
        "*", model.alert_text("inv_velocity", "rain_intensity").alias("alert_level"))


def flat_window(df: DataFrame) -> DataFrame:
    """Replace the ``window`` struct by ``window_start`` / ``window_end`` columns."""
    rest = [c for c in df.columns if c != "window"]
    return df.select(F.col("window.start").alias("window_start"),
                     F.col("window.end").alias("window_end"), *rest)
