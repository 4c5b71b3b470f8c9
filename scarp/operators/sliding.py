"""Trailing RANGE frames as two merged halves: no frame is aggregated anew, nothing is subtracted, a burst is many tasks.

Event time is cut into cells as wide as the frame. The frame ``[t - width, t]`` of a row is then the end of one cell and
the beginning of the next: a *suffix* of the cell before, from ``t - width`` on, and a *prefix* of the row's own cell.
Prefixes and suffixes are running aggregates, computed once per cell (two passes), and merged once per row.

So that a cell with any number of rows is no single task, the rows are ranged by series and time over equal partitions.
A cell that lies in several of them is run through piece by piece; what the earlier (or later) pieces hold comes from one
total per piece. A border of the ranges cuts one cell, so there are at most twice as many such totals as partitions,
which Spark broadcasts by their size. Rows of one series and instant share one frame: they are aggregated first, and the result goes back to
them by series and instant.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, scratch_path
from .resample import epoch_micros
from .sequence import duration_us

Sum = Callable[[Column], Column]


def frame_aggregate(df: DataFrame, keys: Sequence[str], frame: str | int, sums: Mapping[str, Sum], firsts: Mapping[str, Column] | None = None,
                    time_col: str = "event_time", tie_col: str | None = None, partitions: int | None = None) -> DataFrame:
    """``df`` with aggregates of each row's trailing frame (both ends included; rows of the same instant all count).

    ``sums`` maps a name to a function from seconds to the summand: seconds count from the beginning of the row's own cell
    (negative for rows of the cell before), so they stay small and one origin holds for the whole frame. A NULL summand
    adds nothing. ``firsts`` maps a name to a value taken from the frame's first row in (time, tie) order. Rows without
    time get NULLs. ``partitions`` is the number of ranges (default: the session's shuffle partitions).
    """
    firsts = dict(firsts or {})
    width = duration_us(frame)
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = df.withColumn("_us", epoch_micros(df, time_col)).withColumn("_sk", F.struct(*keys))   # structs compare NULLs as equal
    cell = F.floor(F.col("_us") / F.lit(width)).cast("long")
    x = (F.col("_us") - F.col("_cell") * F.lit(width)) / 1e6
    names = list(sums)
    value = F.struct(*[c.alias(n) for n, c in firsts.items()]) if firsts else F.lit(None).cast("struct<_none:int>")
    rank = F.coalesce(F.col(tie_col).cast("long"), F.lit(0)) if tie_col else F.lit(0)
    # one row per series and instant
    at = (d.where(F.col("_us").isNotNull()).withColumn("_cell", cell)
          .select("_sk", "_us", "_cell", value.alias("_f"), rank.alias("_rank"), *[sums[n](x).alias(f"_p_{n}") for n in names],
                  *[sums[n](x - F.lit(width / 1e6)).alias(f"_s_{n}") for n in names])
          .groupBy("_sk", "_us", "_cell").agg(F.min_by("_f", "_rank").alias("_f"), *[F.sum(f"_{r}_{n}").alias(f"_{r}_{n}") for r in "ps" for n in names]))
    at = materialize(at)
    # beside every instant a mark where its frame begins, in the cell before; a mark stands before the rows of its instant
    fields = [f"_{r}_{n}" for r in "ps" for n in names]
    marks = at.select("_sk", (F.col("_us") - F.lit(width)).alias("_us"), (F.col("_cell") - 1).alias("_cell"), F.lit(0).alias("_row"))
    both = at.select("_sk", "_us", "_cell", F.lit(1).alias("_row"), "_f", *fields).unionByName(marks, allowMissingColumns=True)
    ranged = materialize(both.repartitionByRange(parts, "_sk", "_us", "_row").withColumn("_part", F.spark_partition_id()))

    pieces = ranged.repartitionById(parts, F.col("_part"))
    piece = ["_sk", "_cell", "_part"]
    before = Window.partitionBy(*piece).orderBy("_us", "_row").rowsBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy(*piece).orderBy(F.desc("_us"), F.desc("_row")).rowsBetween(Window.unboundedPreceding, 0)
    is_row = F.col("_row") == 1
    held = F.when(is_row, F.struct(F.col("_f").alias("f")))
    run = pieces.select(
        *piece, "_us", "_row",
        *[F.sum(f"_p_{n}").over(before).alias(f"_rp_{n}") for n in names], F.first(held, ignorenulls=True).over(before).alias("_rf"),
        *[F.sum(f"_s_{n}").over(after).alias(f"_rs_{n}") for n in names], F.last(held, ignorenulls=True).over(after).alias("_rl"))

    totals = pieces.groupBy(*piece).agg(*[F.sum(c).alias(f"_t{c}") for c in fields], F.min_by(held, F.when(is_row, F.col("_us"))).alias("_tf"))
    cells = Window.partitionBy("_sk", "_cell")
    earlier = cells.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    later = cells.orderBy("_part").rowsBetween(1, Window.unboundedFollowing)
    # cells in several pieces only: at most two pieces for every border between ranges
    carries = totals.withColumn("_n", F.count(F.lit(1)).over(cells)).where(F.col("_n") > 1).select(
        *piece, *[F.sum(f"_t_p_{n}").over(earlier).alias(f"_cp_{n}") for n in names], F.first("_tf", ignorenulls=True).over(earlier).alias("_cf"),
        *[F.sum(f"_t_s_{n}").over(later).alias(f"_cs_{n}") for n in names], F.first("_tf", ignorenulls=True).over(later).alias("_cl"))
    # written, so that the planner knows its size and decides by it how to join
    place = scratch_path(df.sparkSession, "scarp", "sliding")
    carries.write.parquet(place)
    full = run.join(df.sparkSession.read.schema(carries.schema).parquet(place), piece, "left")

    def total(r: str, n: str) -> Column:
        return F.coalesce(F.col(f"_r{r}_{n}"), F.lit(0.0)) + F.coalesce(F.col(f"_c{r}_{n}"), F.lit(0.0))

    halves = full.select("_sk", F.when(is_row, F.col("_us")).otherwise(F.col("_us") + F.lit(width)).alias("_us"),
                         F.when(is_row, F.coalesce("_cf", "_rf")).alias("_pf"), F.when(~is_row, F.coalesce("_rl", "_cl")).alias("_sf"),
                         *[F.when(is_row, total("p", n)).otherwise(total("s", n)).alias(f"_h_{n}") for n in names])
    frames = halves.groupBy("_sk", "_us").agg(
        *[F.sum(f"_h_{n}").alias(f"_x_{n}") for n in names],
        F.coalesce(F.first("_sf", ignorenulls=True), F.first("_pf", ignorenulls=True)).alias("_f"))
    back = d.join(frames, ["_sk", "_us"], "left")
    return back.select(*df.columns, *[F.col(f"_x_{n}").alias(n) for n in names], *[F.col(f"_f.f.{n}").alias(n) for n in firsts])
