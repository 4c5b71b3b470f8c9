"""Ordered per-series operators that scale past one task per series.

A window partitioned by sensor puts the whole history of a sensor into one
task; with one sensor holding a third of all readings that task is the job.
Here every series is cut into event-time buckets. The heavy work (sorting,
running sums, lags) runs per (series, bucket) in parallel; what has to cross
bucket borders is carried by a small table with one row per (series,
bucket) whose size depends on the time span, not on the data rate.

* ``with_previous``  - lag by one row (previous bucket's tail for the first row)
* ``forward_fill``   - last non-null value so far
* ``running_sum``    - cumulative sum
* ``linear_scan``    - y_n = a_n * y_(n-1) + b_n (damped integration); exact
  carries by composing affine maps in bounded groups (no truncated history)
* ``with_context``   - rows of the previous bucket attached for RANGE frames
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .resample import epoch_micros, order_key

_UNITS_US = {"microsecond": 1, "millisecond": 1000, "second": 1_000_000, "minute": 60_000_000,
             "hour": 3_600_000_000, "day": 86_400_000_000}

# Largest log-magnitude a block's running product may span before a new block
# starts: keeps b / prod(a) far from overflow (e^300 ~ 1e130).
_LOG_SPAN = 300.0
_FANOUT = 64


def duration_us(text: str | int) -> int:
    """'120 seconds' / '2 minutes' / '500 milliseconds' -> microseconds."""
    if isinstance(text, int):
        return text
    m = re.fullmatch(r"\s*(\d+)\s*([a-z]+?)s?\s*", text.lower())
    if not m or m.group(2) not in _UNITS_US:
        raise ValueError(f"bad duration: {text!r}")
    return int(m.group(1)) * _UNITS_US[m.group(2)]


def with_bucket(df: DataFrame, time_col: str, width: str | int, name: str = "_bucket") -> DataFrame:
    w = duration_us(width)
    return df.withColumn(name, F.floor(epoch_micros(df, time_col) / F.lit(w)).cast("long"))


class Buckets(NamedTuple):
    """Range of ``_bucket`` values (after hot-bucket splitting) and the split factor."""
    lo: int
    hi: int
    splits: int


# A (series, bucket) with more rows than this is split (see ``assign_buckets``).
MAX_BUCKET_ROWS = 2_000_000


def assign_buckets(df: DataFrame, keys: Sequence[str], time_col: str = "event_time",
                   tie_col: str | None = "event_id", width: str | int = "120 seconds",
                   max_rows: int | None = MAX_BUCKET_ROWS) -> tuple[DataFrame, Buckets]:
    """Add ``_bucket``: event-time buckets, with hot buckets split by row order.

    One aggregate pass counts rows per (series, bucket); it also yields the
    bucket range that sizes the carry tree. A bucket holding more than
    ``max_rows`` rows (a burst, or one sensor with a third of all data) is cut
    at approximate quantiles of event time inside the bucket; the pieces keep
    the (time, tie) order and go to different tasks. Rows sharing one exact
    timestamp are never separated. No row is dropped.
    Later sequence operators reuse the ``_bucket`` column they find.
    """
    d, keys = _series(with_bucket(df, time_col, width, "_b0"), keys)
    counts = d.groupBy(*keys, "_b0").count()
    lo, hi, top = counts.agg(F.min("_b0"), F.max("_b0"), F.max("count")).first()
    if lo is None:
        return d.withColumnRenamed("_b0", "_bucket").drop("_sk"), Buckets(0, 0, 1)
    if max_rows is None or top <= max_rows:
        return d.withColumnRenamed("_b0", "_bucket").drop("_sk"), Buckets(int(lo), int(hi), 1)
    k = int(math.ceil(top / max_rows))
    # cut points on the time offset inside the bucket (exact as a double);
    # rows with one identical timestamp stay together, which keeps the order
    off = (epoch_micros(d, time_col) - F.col("_b0") * F.lit(duration_us(width))).cast("double")
    d = materialize(d.withColumn("_off", off))      # read by the cut points and by the join below
    hot = (d.groupBy(*keys, "_b0").count().where(F.col("count") > max_rows).select(*keys, "_b0"))
    cuts = (d.join(hot, keys + ["_b0"], "left_semi").groupBy(*keys, "_b0")
            .agg(F.percentile_approx("_off", [i / k for i in range(1, k)], 20 * k).alias("_cuts")))
    j = d.join(cuts, keys + ["_b0"], "left")
    sub = F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(
        F.size(F.filter("_cuts", lambda c: c < F.col("_off"))))
    out = j.select(*df.columns, (F.col("_b0") * F.lit(k) + sub).cast("long").alias("_bucket"))
    return out, Buckets(int(lo) * k, int(hi) * k + k - 1, k)


def _bucketed(df: DataFrame, time_col: str, width: str | int) -> DataFrame:
    """Reuse an assigned ``_bucket`` column, else plain event-time buckets."""
    return df if "_bucket" in df.columns else with_bucket(df, time_col, width)


def _series(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """One struct column for the series key.

    Structs compare NULL members as equal, so a series with a NULL sensor or
    label keeps its carries in plain equi-joins, which reuse the partitioning
    of the windows (a null-safe join on the columns would shuffle again).
    """
    return df.withColumn("_sk", F.struct(*keys)), ["_sk"]


def _order(time_col: str, tie_col: str | None) -> list[Column]:
    return [F.col(time_col)] + ([F.col(tie_col)] if tie_col else [])


def with_previous(df: DataFrame, keys: Sequence[str], cols: Sequence[str], time_col: str = "event_time",
                  tie_col: str | None = "event_id", width: str | int = "120 seconds",
                  prefix: str = "prev_") -> DataFrame:
    """Add ``prev_<c>``: the value of ``c`` in the previous row of the same series."""
    d, keys = _series(_bucketed(df, time_col, width), keys)
    d = d.withColumn("_okey", order_key(d, time_col, tie_col))
    part = keys + ["_bucket"]
    w = Window.partitionBy(*part).orderBy(*_order(time_col, tie_col))
    d = d.select("*", F.lag(F.lit(1)).over(w).isNull().alias("_first"),
                 *[F.lag(c).over(w).alias(f"_lag_{c}") for c in cols])
    # tail (last row) of each bucket, then the tail of the previous non-empty bucket
    tails = d.groupBy(*part).agg(*[F.max_by(c, "_okey").alias(f"_tail_{c}") for c in cols])
    wb = Window.partitionBy(*keys).orderBy("_bucket")
    prev = tails.select(*part, *[F.lag(f"_tail_{c}").over(wb).alias(f"_ptail_{c}") for c in cols])
    j = d.join(prev, part, "left")
    out = j.select(*[F.col(c) for c in df.columns],
                   *[F.when(F.col("_first"), F.col(f"_ptail_{c}")).otherwise(F.col(f"_lag_{c}"))
                     .alias(f"{prefix}{c}") for c in cols])
    return out


def forward_fill(df: DataFrame, keys: Sequence[str], cols: Sequence[str], time_col: str = "event_time",
                 tie_col: str | None = "event_id", width: str | int = "120 seconds",
                 suffix: str = "_filled") -> DataFrame:
    """Add ``<c>_filled``: newest non-null value of ``c`` up to and including this row."""
    d, keys = _series(_bucketed(df, time_col, width), keys)
    d = d.withColumn("_okey", order_key(d, time_col, tie_col))
    part = keys + ["_bucket"]
    w = (Window.partitionBy(*part).orderBy(*_order(time_col, tie_col))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    d = d.select("*", *[F.last(c, ignorenulls=True).over(w).alias(f"_in_{c}") for c in cols])
    tails = d.groupBy(*part).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_okey"))).alias(f"_tail_{c}") for c in cols])
    wb = (Window.partitionBy(*keys).orderBy("_bucket")
          .rowsBetween(Window.unboundedPreceding, -1))
    prev = tails.select(*part, *[F.last(f"_tail_{c}", ignorenulls=True).over(wb).alias(f"_carry_{c}")
                                 for c in cols])
    j = d.join(prev, part, "left")
    return j.select(*[F.col(c) for c in df.columns],
                    *[F.coalesce(F.col(f"_in_{c}"), F.col(f"_carry_{c}")).alias(f"{c}{suffix}") for c in cols])


def running_sum(df: DataFrame, keys: Sequence[str], col: str | Sequence[str], out: str | Sequence[str],
                time_col: str = "event_time", tie_col: str | None = "event_id",
                width: str | int = "120 seconds") -> DataFrame:
    """Cumulative sum of ``col`` (one or several columns) per series in (time, tie) order; NULLs add nothing."""
    cols = [col] if isinstance(col, str) else list(col)
    outs = [out] if isinstance(out, str) else list(out)
    d, keys = _series(_bucketed(df, time_col, width), keys)
    part = keys + ["_bucket"]
    w = (Window.partitionBy(*part).orderBy(*_order(time_col, tie_col))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    d = d.select("*", *[F.sum(c).over(w).alias(f"_in{k}") for k, c in enumerate(cols)])
    totals = d.groupBy(*part).agg(*[F.sum(c).alias(f"_t{k}") for k, c in enumerate(cols)])
    wb = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    prev = totals.select(*part, *[F.sum(f"_t{k}").over(wb).alias(f"_c{k}") for k in range(len(cols))])
    j = d.join(prev, part, "left")
    return j.select(*[F.col(c) for c in df.columns],
                    *[(F.coalesce(F.col(f"_c{k}"), F.lit(0.0)) + F.coalesce(F.col(f"_in{k}"), F.lit(0.0))).alias(o)
                      for k, o in enumerate(outs)])


# ---------------------------------------------------------------- linear scan

def _map_struct(A: Column, Ts: Sequence[Column], i: Column | None = None) -> Column:
    f = ([i.alias("i")] if i is not None else []) + [A.alias("a")] + \
        [t.alias(f"t{k}") for k, t in enumerate(Ts)]
    return F.struct(*f)


def _fold_maps(tbl: DataFrame, group: Sequence[str], idx: str, n: int) -> DataFrame:
    """Compose the affine maps y_k -> A*y_k + T_k of each group in ``idx`` order.

    Returns one row per group: total map (``A``, ``T0..``) and ``pre``, the
    exclusive prefix map of every member. Groups are bounded by construction
    (blocks of one bucket, or ``_FANOUT`` consecutive buckets).
    """
    ts = [f"T{k}" for k in range(n)]
    arr = F.array_sort(F.collect_list(_map_struct(F.col("A"), [F.col(t) for t in ts], F.col(idx).cast("long"))))
    g = tbl.groupBy(*group).agg(arr.alias("_arr"))
    pre_type = "array<struct<i:long,a:double," + ",".join(f"t{k}:double" for k in range(n)) + ">>"
    init = F.struct(F.lit(1.0).alias("A"), *[F.lit(0.0).alias(t) for t in ts],
                    F.array().cast(pre_type).alias("pre"))

    def step(acc, e):
        return F.struct(
            (e["a"] * acc["A"]).alias("A"),
            *[(e["a"] * acc[t] + e[f"t{k}"]).alias(t) for k, t in enumerate(ts)],
            F.array_append(acc["pre"], _map_struct(acc["A"], [acc[t] for t in ts], e["i"])).alias("pre"))

    folded = F.aggregate("_arr", init, step)
    return g.select(*group, folded.alias("_f")).select(*group, "_f.*")


def _affine_carry(tbl: DataFrame, keys: list[str], idx: str, n: int, depth: int) -> DataFrame:
    """Exclusive prefix of affine maps over ``idx`` (per series) -> (keys, idx, c0..).

    ``c_k`` is y_k just before the map at ``idx`` is applied, starting from 0.
    Tree of fan-out ``_FANOUT``: each level composes bounded groups; ``depth``
    more levels are needed above this one to cover the index span.
    """
    t = tbl.withColumn("_grp", F.floor(F.col(idx) / _FANOUT).cast("long"))
    f = _fold_maps(t, keys + ["_grp"], idx, n)
    pre = f.select(*keys, "_grp", F.inline("pre")).withColumnRenamed("i", idx)
    if depth <= 0:
        return pre.select(*keys, idx, *[F.col(f"t{k}").alias(f"c{k}") for k in range(n)])
    up = f.select(*keys, F.col("_grp").alias("_gidx"), "A", *[f"T{k}" for k in range(n)])
    upc = _affine_carry(up, keys, "_gidx", n, depth - 1).withColumnRenamed("_gidx", "_grp")
    upc = upc.select(*keys, "_grp", *[F.col(f"c{k}").alias(f"_g{k}") for k in range(n)])
    j = pre.join(upc, keys + ["_grp"], "left")
    return j.select(*keys, idx, *[(F.col("a") * F.coalesce(f"_g{k}", F.lit(0.0)) + F.col(f"t{k}")).alias(f"c{k}")
                                  for k in range(n)])


def linear_scan(df: DataFrame, keys: Sequence[str], a: Column, bs: Sequence[Column], outs: Sequence[str],
                time_col: str = "event_time", tie_col: str | None = "event_id",
                width: str | int = "120 seconds", prev_outs: Sequence[str] | None = None,
                buckets: Buckets | None = None, checkpoint: bool = True) -> DataFrame:
    """y_n = a_n * y_(n-1) + b_n per series for each b in ``bs`` (shared ``a`` > 0); y_(-1) = 0.

    Rows of a (series, bucket) are cut into blocks whose running product of
    ``a`` spans at most e^300, so inside a block y = P_j * sum(b_i / P_i) is
    a plain window sum without overflow. Blocks and buckets are then affine
    maps (A, T); their carries are composed exactly (no history is dropped)
    in bounded groups: blocks within a bucket, then a fan-out tree over buckets.
    ``prev_outs`` optionally names y_(n-1) columns. ``buckets`` is the range
    returned by ``assign_buckets`` for a frame carrying ``_bucket``; without
    it, buckets are assigned here (one aggregate pass). Requires a_n > 0.
    ``checkpoint`` writes the windowed rows once to the shared checkpoint
    folder, since both the block maps and the final join read them.
    """
    keys, n = list(keys), len(bs)
    orig_cols = list(df.columns)
    if buckets is None or "_bucket" not in df.columns:
        df, buckets = assign_buckets(df.drop("_bucket") if "_bucket" in df.columns else df, keys, time_col,
                                     tie_col, width)
    d, keys = _series(df.select("*", a.alias("_a"), *[b.alias(f"_b{k}") for k, b in enumerate(bs)]), keys)
    d = d.withColumn("_okey", order_key(d, time_col, tie_col))
    part = keys + ["_bucket"]
    order = _order(time_col, tie_col)
    w1 = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_blk", F.floor(-F.sum(F.log(F.col("_a"))).over(w1) / _LOG_SPAN).cast("long"))
    w2 = Window.partitionBy(*part, "_blk").orderBy(*order)
    w2c = w2.rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_P", F.exp(F.sum(F.log(F.col("_a"))).over(w2c)))
    d = d.select("*", *[(F.col("_P") * F.sum(F.col(f"_b{k}") / F.col("_P")).over(w2c)).alias(f"_loc{k}")
                        for k in range(n)])
    d = d.select("*", F.coalesce(F.lag("_P").over(w2), F.lit(1.0)).alias("_Pp"),
                 *[F.coalesce(F.lag(f"_loc{k}").over(w2), F.lit(0.0)).alias(f"_locp{k}") for k in range(n)])
    if checkpoint:
        # the windowed rows feed both the block maps and the final join
        d = materialize(d)

    blocks = d.groupBy(*part, "_blk").agg(F.max_by("_P", "_okey").alias("A"),
                                          *[F.max_by(f"_loc{k}", "_okey").alias(f"T{k}") for k in range(n)])
    # fold the blocks of each bucket: bucket maps + in-bucket prefix of each block
    fb = _fold_maps(blocks, part, "_blk", n)
    lo, hi = buckets.lo, buckets.hi
    span = int(hi - lo + 1)
    depth = max(0, math.ceil(math.log(span, _FANOUT)) - 1) if span > 1 else 0
    bucket_maps = fb.select(*keys, (F.col("_bucket") - F.lit(lo)).alias("_bidx"), "A",
                            *[f"T{k}" for k in range(n)])
    bc = _affine_carry(bucket_maps, keys, "_bidx", n, depth).select(
        *keys, (F.col("_bidx") + F.lit(lo)).alias("_bucket"), *[F.col(f"c{k}").alias(f"_bc{k}") for k in range(n)])
    blk_pre = fb.select(*part, F.inline("pre"))
    blk_carry = (blk_pre.join(bc, part, "left")
                 .select(*part, F.col("i").alias("_blk"),
                         F.struct(*[(F.col("a") * F.coalesce(f"_bc{k}", F.lit(0.0)) + F.col(f"t{k}")).alias(f"c{k}")
                                    for k in range(n)]).alias("_c")))
    # one row per (series, bucket) holding its blocks' carries: the join keeps
    # the row side on its (series, bucket) partitioning
    cmap = blk_carry.groupBy(*part).agg(F.map_from_entries(F.collect_list(F.struct("_blk", "_c"))).alias("_cm"))
    j = d.join(cmap, part, "left").withColumn("_cc", F.element_at("_cm", F.col("_blk")))
    cols = [F.col(c) for c in orig_cols]
    for k in range(n):
        carry = F.coalesce(F.col(f"_cc.c{k}"), F.lit(0.0))
        cols.append((F.col("_P") * carry + F.col(f"_loc{k}")).alias(outs[k]))
        if prev_outs:
            cols.append((F.col("_Pp") * carry + F.col(f"_locp{k}")).alias(prev_outs[k]))
    return j.select(*cols)


# ------------------------------------------------------------ RANGE framing

def with_context(df: DataFrame, time_col: str, frame: str | int, width: str | int = "120 seconds") -> DataFrame:
    """Rows of each bucket plus, as context, the rows of the previous bucket.

    A RANGE frame reaching back ``frame`` then finds every row it needs in its
    own (series, ``_part``) partition as long as ``width >= frame``. Output has
    ``_part`` (the bucket computed in) and ``_own`` (row belongs to ``_part``).
    Keep ``_own`` rows after the window. Costs one extra copy of the rows.
    """
    if duration_us(width) < duration_us(frame):
        raise ValueError("bucket width must cover the frame")
    d = with_bucket(df, time_col, width)
    return (d.select("*", F.explode(F.array(
        F.struct(F.col("_bucket").alias("p"), F.lit(True).alias("own")),
        F.struct((F.col("_bucket") + 1).alias("p"), F.lit(False).alias("own")))).alias("_x"))
        .select(*df.columns, F.col("_x.p").alias("_part"), F.col("_x.own").alias("_own")))
