"""Fukuzono inverse-velocity rule and the alert ladders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed thresholds and texts of the alert model.
VELOCITY_FLOOR = 1e-5
INVERSE_DEFAULT = 1000.0
DANGER_INVERSE = 10.0
HEAVY_RAIN = 50.0
HIGH_VIBRATION = 0.5
DANGER_TEXT = "DANGER: LANDSLIDE IMMINENT"
HEAVY_RAIN_TEXT = "WARNING: HEAVY RAIN"
HIGH_RISK_TEXT = "WARNING: HIGH RISK CONDITIONS"
NORMAL_TEXT = "NORMAL"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def inverse_velocity(v, floor: float = VELOCITY_FLOOR, default: float = INVERSE_DEFAULT) -> Column:
    """1/v when v exceeds ``floor``; ``default`` otherwise (also for NULL v)."""
    v = _c(v)
    return F.when(v > F.lit(floor), F.lit(1.0) / v).otherwise(F.lit(default))


def alert_text(inv, rain, danger: float = DANGER_INVERSE, heavy_rain: float = HEAVY_RAIN) -> Column:
    """Core job ladder: DANGER, then heavy-rain warning, else NORMAL."""
    return (F.when(_c(inv) < F.lit(danger), F.lit(DANGER_TEXT))
            .when(_c(rain) > F.lit(heavy_rain), F.lit(HEAVY_RAIN_TEXT))
            .otherwise(F.lit(NORMAL_TEXT)))


def alert_level(inv, rain, vibration, danger: float = DANGER_INVERSE,
                heavy_rain: float = HEAVY_RAIN, high_vibration: float = HIGH_VIBRATION) -> Column:
    """Monitoring ladder: 3 = danger, 2 = heavy rain or strong vibration, 1 = normal."""
    return (F.when(_c(inv) < F.lit(danger), F.lit(3))
            .when(_c(rain) > F.lit(heavy_rain), F.lit(2))
            .when(_c(vibration) > F.lit(high_vibration), F.lit(2))
            .otherwise(F.lit(1)))


def alert_message(level) -> Column:
    level = _c(level)
    return (F.when(level == 3, F.lit(DANGER_TEXT))
            .when(level == 2, F.lit(HIGH_RISK_TEXT))
            .otherwise(F.lit(NORMAL_TEXT)))


def core_output(df, time_col: str = "window.start"):
    """Rename and decimal casts of the core job's printed rows.

    ``try_cast`` keeps an out-of-range or NaN value from failing the stream.
    """
    return df.select(
        F.col(time_col).alias("time"),
        F.col("alert_level"),
        F.col("inv_velocity").try_cast("decimal(10,2)").alias("inv_velocity"),
        F.col("avg_velocity").try_cast("decimal(10,5)").alias("avg_velocity"),
        F.col("last_gnss_x").try_cast("decimal(10,2)").alias("last_gnss_x"),
        F.col("rain_intensity"),
    )
