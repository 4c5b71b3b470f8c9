"""Resting vector of every acceleration sensor, learned from its own still periods.

A sensor is mounted at its own tilt, so gravity splits over its axes in its own way. One pass over the readings gives per
sensor and window the spread of every axis and a quantile sketch of its values; everything after that works on this small
table. Still are the windows whose spread is close to the smallest spreads of that sensor; their sketches merge, and the
medians of the merged sketches are the resting vector. A disturbed window never enters, and no reading is read twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import features as fx

AXES = ("acc_x", "acc_y", "acc_z")
# sketch size: values up to about this many are kept exactly, beyond that the rank error is about 1 / SKETCH
SKETCH = 16384


def resting_vectors(imu: DataFrame, keys: Sequence[str] = ("sensor_id",), window: str = "10 seconds", share: float = 0.25,
                    factor: float = 3.0, least: int = 5, time_col: str = "event_time", axes: Sequence[str] = AXES) -> DataFrame:
    """``keys, windows, n, base_<axis>``: still windows, readings in them and the median of every axis over those.

    A window of at least ``least`` readings is still if its spread (the sum of max - min over the axes) is at most
    ``factor`` times the ``share`` quantile of the sensor's spreads. Readings without time or with a missing axis take no
    part; a sensor without such windows has no row.
    """
    keys = list(keys)
    whole = imu.where(F.col(time_col).isNotNull())
    for a in axes:
        whole = whole.where(F.col(a).isNotNull() & ~F.isnan(a))
    spread = sum((F.max(a) - F.min(a) for a in axes[1:]), F.max(axes[0]) - F.min(axes[0]))
    cells = whole.groupBy(*keys, F.window(time_col, window).alias("_w")).agg(
        spread.alias("_spread"), F.count(F.lit(1)).alias("_n"), *[F.kll_sketch_agg_double(a, SKETCH).alias(f"_k_{a}") for a in axes])
    cells = cells.where(F.col("_n") >= least).withColumn("_sk", F.struct(*keys))       # structs compare NULLs as equal
    limits = cells.groupBy("_sk").agg(F.percentile_approx("_spread", share, 100_000).alias("_limit"))
    still = cells.join(limits, "_sk").where(F.col("_spread") <= F.col("_limit") * F.lit(factor))
    merged = still.groupBy("_sk").agg(F.count(F.lit(1)).alias("windows"), F.sum("_n").alias("n"),
                                      *[F.kll_merge_agg_double(f"_k_{a}", SKETCH).alias(f"_k_{a}") for a in axes])
    return merged.select("_sk.*", "windows", "n", *[F.kll_sketch_get_quantile_double(f"_k_{a}", F.lit(0.5)).alias(f"base_{a}") for a in axes])


def with_resting(imu: DataFrame, vectors: DataFrame, keys: Sequence[str] = ("sensor_id",), axes: Sequence[str] = AXES,
                 default: Sequence[float] = fx.BASE_ACCELERATION) -> DataFrame:
    """Readings with the resting vector of their sensor (``base_<axis>``); ``default`` where the sensor has none.

    One row per sensor is joined; Spark broadcasts it where its size allows.
    """
    keys = list(keys)
    rows = imu.withColumn("_sk", F.struct(*keys))
    base = vectors.select(F.struct(*keys).alias("_sk"), *[F.col(f"base_{a}").alias(f"_base_{a}") for a in axes])
    return rows.join(base, "_sk", "left").select(
        *imu.columns, *[F.coalesce(f"_base_{a}", F.lit(float(d))).alias(f"base_{a}") for a, d in zip(axes, default)])


def dynamic(axes: Sequence[str] = AXES) -> tuple[Column, Column, Column]:
    """Acceleration less the joined resting vector, per axis."""
    return fx.dynamic_acceleration(*axes, base=[F.col(f"base_{a}") for a in axes])
