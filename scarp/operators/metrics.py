"""Label-set metrics: selectors, counter rate, instant vectors, series arithmetic.

Input is a long table ``(ts, metric, <labels>, value)``; a missing label
counts as the empty string.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from . import sequence as sq
from .resample import epoch_micros, order_key
from .sliding import frame_aggregate


def select(df: DataFrame, metric: str | None = None, **matchers: str) -> DataFrame:
    """Label matchers: ``mode="idle"`` is equality, ``device="!lo"`` is inequality."""
    cond = F.lit(True)
    if metric is not None:
        cond = cond & (F.col("metric") == metric)
    for label, want in matchers.items():
        have = F.coalesce(F.col(label), F.lit(""))
        cond = cond & ((have != want[1:]) if want.startswith("!") else (have == want))
    return df.where(cond)


def counter_rate(df: DataFrame, keys: Sequence[str] = ("metric", "instance", "mode"), range_: str = "60 seconds",
                 time_col: str = "ts", tie_col: str | None = "sample_id",
                 width: str | int = "120 seconds", method: str = "blocks") -> DataFrame:
    """Per-second increase of a counter over the trailing range, at every sample.

    Steps come from the previous sample (a drop is a reset: the step is the
    new value). Inside the RANGE frame, steps after the frame's first sample
    are summed and divided by the observed span; one sample gives NULL.
    No extrapolation to the range borders (unlike PromQL).
    ``method="blocks"`` merges two running halves per frame (``sliding``) and
    cuts hot buckets, so that a burst is spread over many tasks;
    ``"prefix"`` takes frame sums as differences of running sums, a bucket in
    one task.
    """
    keys = list(keys)
    df = df.withColumns({k: F.coalesce(k, F.lit("")) for k in keys})
    d = df
    if method == "blocks":
        d, _ = sq.assign_buckets(df, keys, time_col, tie_col, width)
    p = sq.with_previous(d, keys, ["value"], time_col, tie_col, width)
    step = F.when(F.col("prev_value").isNull(), F.lit(0.0)) \
        .when(F.col("value") < F.col("prev_value"), F.col("value")) \
        .otherwise(F.col("value") - F.col("prev_value"))
    if method == "blocks":
        p = materialize(p.select(*df.columns, step.alias("_step")))
        us = epoch_micros(p, time_col)
        m = frame_aggregate(p, keys, range_, {"_sum": lambda x: F.col("_step")}, {"_first": F.col("_step"), "_since": us}, time_col, tie_col)
        span = (us - F.col("_since")) / 1e6
        return m.select(*df.columns, F.when(span > 0, (F.col("_sum") - F.col("_first")) / span).alias("rate"))
    p = p.withColumn("_step", step).withColumn("_us", epoch_micros(p, time_col))
    ctx = sq.with_context(p, time_col, range_, width)
    # Frame sums as differences of growing-frame prefix sums: Spark updates
    # those incrementally (O(n)), where a sliding RANGE frame is re-aggregated
    # for every row. The frame's first sample is the one after the last sample
    # before the frame (``lead``); ordering ties are broken by row number.
    part = Window.partitionBy(*keys, "_part")
    tie = [F.col(tie_col)] if tie_col else []
    exact = part.orderBy(F.col("_us"), *tie)
    ctx = ctx.select("*", F.row_number().over(exact).alias("_rn"),
                     F.lead("_step").over(exact).alias("_next_step"), F.lead("_us").over(exact).alias("_next_us"))
    by_time = part.orderBy("_us")
    upto = by_time.rangeBetween(Window.unboundedPreceding, 0)
    before = by_time.rangeBetween(Window.unboundedPreceding, -(sq.duration_us(range_) + 1))
    in_frame = F.sum("_step").over(upto) - F.coalesce(F.sum("_step").over(before), F.lit(0.0))
    first_step = F.coalesce(F.max_by("_next_step", "_rn").over(before), F.min_by("_step", "_rn").over(part))
    first_us = F.coalesce(F.max_by("_next_us", "_rn").over(before), F.min_by("_us", "_rn").over(part))
    span = (F.col("_us") - first_us) / 1e6
    out = ctx.select(*df.columns, "_own", F.when(span > 0, (in_frame - first_step) / span).alias("rate"))
    return out.where("_own").drop("_own")


def instant_select(df: DataFrame, keys: Sequence[str] = ("metric", "instance", "mode"), lookback: str = "5 minutes",
                   as_of=None, time_col: str = "ts", tie_col: str | None = None) -> DataFrame:
    """Newest sample of each label set within the lookback before ``as_of`` (default: newest ts); ``tie_col`` decides
    between equal times (default: ``sample_id`` where there is one)."""
    from .series import newest_rank, time_range
    recent = time_range(df, lookback, as_of, time_col)
    tie = tie_col or ("sample_id" if "sample_id" in df.columns else None)
    return recent.groupBy(*keys).agg(F.max(time_col).alias(time_col), F.max_by("value", newest_rank(recent, time_col, tie)).alias("value"))


def range_eval(df: DataFrame, step: str, keys: Sequence[str] = ("metric", "instance", "mode"),
               lookback: str = "5 minutes", time_col: str = "ts", tie_col: str | None = "sample_id") -> DataFrame:
    """Values of every series at common instants (whole multiples of ``step``), as range panels need.

    A series has at an instant its newest sample of the lookback before it (the
    sample itself included), or no row. Samples are first reduced to one per
    series and step, which bounds what is copied forward to ``lookback/step``
    rows each; both steps are aggregates, so a hot series is combined early.
    """
    keys, width, reach = list(keys), sq.duration_us(step), sq.duration_us(lookback)
    us = epoch_micros(df, time_col)
    rank = order_key(df, time_col, tie_col)
    first = F.ceil(us / F.lit(width)).cast("long")  # the first instant that sees the sample
    one = (df.groupBy(*keys, first.alias("_at"))
           .agg(F.max_by("value", rank).alias("value"), F.max(us).alias("_us"), F.max(rank).alias("_rank")))
    last = F.floor((F.col("_us") + F.lit(reach)) / F.lit(width)).cast("long")
    newest = one.agg(F.max("_at")).scalar()  # no instants after the first that sees every sample
    seen = one.select("*", F.explode(F.sequence(F.col("_at"), F.least(last, newest))).alias("_i"))
    out = seen.where((F.col("_i") * F.lit(width) - F.col("_us")) < F.lit(reach) + 1).groupBy(*keys, "_i").agg(
        F.max_by("value", "_rank").alias("value"))
    return out.select(F.timestamp_micros(F.col("_i") * F.lit(width)).cast(df.schema[time_col].dataType).alias(time_col), *keys, "value")


def count_series(df: DataFrame, keys: Sequence[str] = ("metric", "instance", "mode"), lookback: str = "5 minutes",
                 time_col: str = "ts") -> DataFrame:
    """Number of label sets present at the newest instant (``count(selector)``)."""
    inst = instant_select(df, keys, lookback, time_col=time_col)
    return inst.agg(F.max(time_col).alias("as_of"), F.count(F.lit(1)).alias("n"))


def avg_by(df: DataFrame, by: Sequence[str], value_col: str = "value", time_col: str = "ts") -> DataFrame:
    """``avg by (labels)`` at each evaluation time."""
    return df.groupBy(time_col, *by).agg(F.avg(value_col).alias(value_col))


def pivot_metrics(df: DataFrame, metrics: Sequence[str], on: Sequence[str] = ("ts", "instance")) -> DataFrame:
    """One column per metric, matched on (time, labels) - one shuffle, no join."""
    return (df.where(F.col("metric").isin(*metrics)).groupBy(*on)
            .agg(*[F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in metrics]))


def metric_difference(df: DataFrame, a: str, b: str, on: Sequence[str] = ("ts", "instance"),
                      out: str = "value") -> DataFrame:
    """``a - b`` for label sets present in both (vector matching on ``on``)."""
    p = pivot_metrics(df, [a, b], on)
    return p.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(*on, (F.col(a) - F.col(b)).alias(out))


def metric_ratio(df: DataFrame, total: str, available: str, on: Sequence[str] = ("ts", "instance"),
                 out: str = "value") -> DataFrame:
    """``(total - available) / total``; a zero total gives NULL."""
    p = pivot_metrics(df, [total, available], on)
    return p.where(F.col(total).isNotNull() & F.col(available).isNotNull()).select(
        *on, F.try_divide(F.col(total) - F.col(available), F.col(total)).alias(out))
