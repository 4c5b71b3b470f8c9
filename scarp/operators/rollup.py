"""Roll-ups: mergeable states of stored series, from points to 10 s, 5 min and days, so that panels never read points.

A state summarises the values of one series in one window: counts, exact sum, extremes, first and last value, and what
the panels' *delta* needs. Two states of consecutive stretches merge into the state of both, in time order, so a wider
window comes from the narrower ones and any range of whole windows from the widest that fit.

Delta adds increases; after a drop the next rise counts from zero, and a drop on the very last value adds that value.
Inside a state ``core`` is the sum of its steps without that last rule. Two facts make it mergeable: a step depends on the
step before it only through "was that one a rise", and the first step of a state was added as if a rise had come before
it. So a state keeps whether its first and its last step rise; at a merge the step over the border is added, and where
that is a drop while the later state's first step rises, that step counts from zero after all: its first value is added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import POINT_FIELDS
from .resample import epoch_micros
from .sequence import duration_us
from .series import points_long

LEVELS = ("10 seconds", "5 minutes", "1 day")

# fixed layout of a state (a sum of two such totals still keeps all digits); ``n`` counts values, ``points`` also the points without one; newest may be NULL
STATE = {"n": "long", "points": "long", "total": "decimal(37,9)", "low": "double", "high": "double", "first": "double", "last": "double",
         "newest": "double", "core": "double", "first_up": "boolean", "last_up": "boolean"}


def point_states(long: DataFrame, time_col: str = "time", keys: Sequence[str] = ("cluster_id", "field")) -> DataFrame:
    """Every stored point as a state of its own instant ``at`` (microseconds)."""
    v = F.col("value")
    some = v.isNotNull()
    state = {"n": F.when(some, 1).otherwise(0), "points": F.lit(1), "total": F.coalesce(v.cast("decimal(18,9)"), F.lit(0)), "low": v, "high": v,
             "first": v, "last": v, "newest": v, "core": F.lit(0.0), "first_up": F.lit(None), "last_up": F.lit(None)}
    return long.select(*keys, epoch_micros(long, time_col).alias("at"), *[state[c].cast(t).alias(c) for c, t in STATE.items()])


def _merged(a: Column, b: Column) -> Column:
    """State of two consecutive stretches."""
    both = (a["n"] > 0) & (b["n"] > 0)
    up = b["first"] >= a["last"]
    rising = a["last_up"].isNull() | a["last_up"]
    step = F.when(up, F.when(rising, b["first"] - a["last"]).otherwise(b["first"])).otherwise(F.lit(0.0))
    again = F.when(~up & b["first_up"], b["first"]).otherwise(F.lit(0.0))
    core = a["core"] + b["core"] + F.when(both, step + again).otherwise(F.lit(0.0))

    def border(kept: Column, other: Column) -> Column:
        """The flag of one side, else of the step over the border, else of the other side."""
        return F.when(both, F.coalesce(kept, up)).otherwise(F.coalesce(kept, other))

    out = {"n": a["n"] + b["n"], "points": a["points"] + b["points"], "total": (a["total"] + b["total"]).cast("decimal(37,9)"),
           "low": F.least(a["low"], b["low"]), "high": F.greatest(a["high"], b["high"]), "first": F.coalesce(a["first"], b["first"]),
           "last": F.coalesce(b["last"], a["last"]), "newest": F.when(b["points"] > 0, b["newest"]).otherwise(a["newest"]), "core": core,
           "first_up": border(a["first_up"], b["first_up"]), "last_up": border(b["last_up"], a["last_up"])}
    return F.struct(*[out[c].cast(t).alias(c) for c, t in STATE.items()])


def compose(states: DataFrame, every: str | None, keys: Sequence[str] = ("cluster_id", "field")) -> DataFrame:
    """States of windows of ``every`` (None: of the whole range) from those of narrower ones; ``at`` is the window's start.

    A window merges as many states as narrower windows fit in it, in time order.
    """
    at = F.lit(0).cast("long") if every is None else F.floor(F.col("at") / F.lit(duration_us(every))).cast("long") * F.lit(duration_us(every))
    each = F.struct("at", *STATE)
    lists = states.select(*keys, at.alias("_at"), each.alias("_s")).groupBy(*keys, "_at").agg(F.array_sort(F.collect_list("_s")).alias("_l"))
    blank = {"n": 0, "points": 0, "total": 0, "core": 0.0}
    none = F.struct(*[F.lit(blank.get(c)).cast(t).alias(c) for c, t in STATE.items()])
    one = F.aggregate("_l", none, _merged)
    return lists.select(*keys, F.col("_at").alias("at"), one.alias("_m")).select(*keys, "at", "_m.*")


def rolled(long: DataFrame, *levels: str, keys: Sequence[str] = ("cluster_id", "field"), time_col: str = "time") -> DataFrame:
    """States at the last of ``levels``, each built from the one before (default: all of ``LEVELS``)."""
    states = point_states(long, time_col, keys)
    for every in levels or LEVELS:
        states = compose(states, every, keys)
    return states


def _mean(total: Column, n: Column) -> Column:
    """The fixed-point mean of ``resample.exact_mean``, from the exact sum."""
    # operands narrow enough that the quotient keeps 19 digits after the point
    mean = (total.cast("decimal(28,9)") / F.when(n > 0, n).cast("decimal(13,0)")).cast("decimal(22,13)")
    return F.round(mean, 6).cast("double")


def panel_of(states: DataFrame, keys: Sequence[str] = ("cluster_id", "field")) -> DataFrame:
    """Panel reducers per series over all given states: equal to ``series.panel_stats(exact=True)`` of their points."""
    s = compose(states, None, keys)
    ends = F.when((F.col("n") > 1) & ~F.col("last_up"), F.col("last")).otherwise(F.lit(0.0))
    return s.select(*keys, F.col("newest").alias("last"), F.col("last").alias("last_not_null"), _mean(F.col("total"), F.col("n")).alias("mean"),
                    F.col("low").alias("min"), F.col("high").alias("max"), F.col("n"), F.when(F.col("n") > 0, F.col("core") + ends).alias("delta"))


def window_means(states: DataFrame, every: str, keys: Sequence[str] = ("cluster_id", "field"), time_type: str = "timestamp_ntz") -> DataFrame:
    """Mean per window of ``every``, stamped with its stop: ``series.aggregate_window(fn='exact_mean')`` from states of ``every``."""
    stop = F.timestamp_micros(F.col("at") + F.lit(duration_us(every))).cast(time_type)
    return states.where(F.col("n") > 0).select(stop.alias("time"), *keys, _mean(F.col("total"), F.col("n")).alias("value"))


def points_in_windows(points: DataFrame, windows: DataFrame, every: str, fields: Sequence[str] = POINT_FIELDS) -> DataFrame:
    """Long points (NULLs kept) of the given windows ``(cluster_id, at, date)`` of ``every``."""
    at = F.floor(epoch_micros(points, "time") / F.lit(duration_us(every))).cast("long") * F.lit(duration_us(every))
    inside = points.withColumn("at", at).join(windows, ["cluster_id", "at", "date"], "left_semi")
    return points_long(inside.drop("at"), keep_nulls=True, fields=fields)
