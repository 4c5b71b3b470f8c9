"""Stored-point queries: the dashboard's time-series operators on a points table.

Points are the per-cluster 1-s alert rows (one row per cluster-second), in
wide form ``(time, cluster_id, <fields>)`` or long form
``(time, cluster_id, field, value)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import panels as pn
from ..schema import POINT_FIELDS
from . import sequence as sq
from .resample import order_key


def to_points(alerts: DataFrame, zero_fill: bool = False) -> DataFrame:
    """Per-cluster alert rows -> wide points (tag defaults to 'unknown').

    ``zero_fill`` writes 0 for a missing field, like the reference sink; by
    default a missing field stays NULL (absent from the long form).
    """
    src = {"gnss_x": "last_gnss_x", "gnss_y": "last_gnss_y"}
    cols = []
    for f in POINT_FIELDS:
        c = F.col(src.get(f, f)).cast("double")
        cols.append((pn.field_default(c) if zero_fill else c).alias(f))
    return alerts.select(F.col("window.start").alias("time"), pn.tag_default("cluster_id").alias("cluster_id"), *cols)


def points_long(points: DataFrame, keep_nulls: bool = False, fields: Sequence[str] = POINT_FIELDS) -> DataFrame:
    """Wide points -> ``(time, cluster_id, field, value)``; a row per present field."""
    long = points.unpivot(["time", "cluster_id"], list(fields), "field", "value")
    return long if keep_nulls else long.where(F.col("value").isNotNull())


def newest_time(df: DataFrame, time_col: str = "time") -> Column:
    """``max(time)`` of a frame as a scalar subquery (planned once, no collect)."""
    return df.select(F.max(time_col)).scalar()


def time_range(df: DataFrame, since: str | int, as_of: Column | None = None, time_col: str = "time") -> DataFrame:
    """Rows with ``time >= as_of - since`` and ``time <= as_of``; ``as_of`` defaults to the newest time."""
    as_of = newest_time(df, time_col) if as_of is None else as_of
    lo = as_of - F.make_dt_interval(secs=F.lit(sq.duration_us(since) / 1e6).cast("decimal(18,6)"))
    cond = (F.col(time_col) >= lo) & (F.col(time_col) <= as_of)
    if "date" in df.columns:             # stored points: prune whole date partitions
        cond = cond & (F.col("date") >= F.to_date(lo))
    return df.where(cond)


def aggregate_window(long: DataFrame, every: str = "1 second", fn: str = "mean", label: str = "stop",
                     keys: Sequence[str] = ("cluster_id", "field"), time_col: str = "time") -> DataFrame:
    """Downsample each series to windows of ``every`` (no empty windows).

    The window is stamped with its stop time by default, as the dashboard's
    downsampling does; ``label='start'`` stamps the start instead.
    ``fn='exact_mean'`` is the fixed-point mean rounded to 6 digits.
    """
    from .resample import exact_mean
    agg = {"mean": F.avg, "exact_mean": exact_mean, "max": F.max, "min": F.min, "sum": F.sum,
           "count": F.count}[fn]
    g = long.groupBy(F.window(time_col, every).alias("w"), *keys).agg(agg("value").alias("value"))
    return g.select(F.col("w.end" if label == "stop" else "w.start").alias(time_col), *keys, "value")


def newest_rank(df: DataFrame, time_col: str, tie_col: str | None = None) -> Column:
    """Numeric order of rows by time; among equal times by the tie id, or without one by the value's hash, never by arrival."""
    if tie_col is not None:
        return order_key(df, time_col, tie_col)
    tie = F.xxhash64("value").bitwiseAND(F.lit((1 << 63) - 1)).cast("decimal(38,0)")
    return order_key(df, time_col, None) * F.lit("10000000000000000000").cast("decimal(38,0)") + tie


def latest(long: DataFrame, keys: Sequence[str] = ("cluster_id", "field"), time_col: str = "time",
           tie_col: str | None = None) -> DataFrame:
    """Newest value and its time per series; ``tie_col`` decides between equal times."""
    return long.groupBy(*keys).agg(F.max(time_col).alias(time_col), F.max_by("value", newest_rank(long, time_col, tie_col)).alias("value"))


def tag_values(df: DataFrame, tag: str = "cluster_id", since: str = "30 days", time_col: str = "time") -> DataFrame:
    """Distinct values of a tag seen in the trailing range."""
    return time_range(df.select(time_col, tag), since, time_col=time_col).select(tag).distinct()


def panel_stats(long: DataFrame, keys: Sequence[str] = ("cluster_id", "field"), time_col: str = "time",
                width: str | int = "120 seconds", exact: bool = False) -> DataFrame:
    """Panel reducers per series: last, lastNotNull, mean, min, max, count and delta.

    delta adds increases; after a drop (counter reset) the next increase
    counts from zero, and a drop on the final value adds that value.
    """
    from .resample import exact_mean
    keys = list(keys)
    present = long.where(F.col("value").isNotNull())
    p = sq.with_previous(present, keys, ["value"], time_col, None, width)
    p = sq.with_previous(p, keys, ["prev_value"], time_col, None, width)
    ends = present.groupBy(*keys).agg(F.max(time_col).alias("_end"))
    v, p1, p2 = F.col("value"), F.col("prev_value"), F.col("prev_prev_value")
    up, prev_up = v >= p1, p2.isNull() | (p1 >= p2)
    step = (F.when(p1.isNull(), F.lit(0.0))
            .when(up, F.when(prev_up, v - p1).otherwise(v))
            .when(F.col(time_col) == F.col("_end"), v)
            .otherwise(F.lit(0.0)))
    deltas = p.join(ends, keys).groupBy(*keys).agg(F.sum(step).alias("delta"))
    rank = newest_rank(long, time_col)
    stats = long.groupBy(*keys).agg(
        F.max_by("value", rank).alias("last"),
        F.max_by("value", F.when(F.col("value").isNotNull(), rank)).alias("last_not_null"),
        (exact_mean("value") if exact else F.avg("value")).alias("mean"), F.min("value").alias("min"), F.max("value").alias("max"),
        F.count("value").alias("n"))
    return stats.join(deltas, keys, "left")


def head_per_series(df: DataFrame, keys: Sequence[str], n: int, time_col: str = "time",
                    tie_col: str | None = None, width: str | int | None = None) -> DataFrame:
    """First ``n`` rows of every series by time (limit per series).

    One ``row_number`` window: Spark puts a group limit before the shuffle, so
    a task sends at most ``n`` rows per series and no task sorts a whole one.
    ``width`` is accepted for older callers and has no effect.
    """
    order = [F.col(time_col)] + ([F.col(tie_col)] if tie_col else [])
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).select(*df.columns)


def select_points(long: DataFrame, fields: Sequence[str] | None = None, **tags: str | Sequence[str]) -> DataFrame:
    """Stored points of the named fields and tag values (one value or several per tag).

    The filters are on stored columns, so they reach the scan or the unpivot
    below; a table holds one measurement, as the points table does.
    """
    out = long if fields is None else long.where(F.col("field").isin(*fields))
    for tag, want in tags.items():
        out = out.where(F.col(tag).isin(*([want] if isinstance(want, str) else want)))
    return out
