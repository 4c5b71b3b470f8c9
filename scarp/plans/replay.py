"""Stored readings written as messages, for streams that replay them (queries and tests)."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.resample import epoch_micros
from ..session import is_local_path, local_fs_path, scratch_path
from ..sources import envelopes as ev

SLICE_ROWS = 1_000_000
_FIRST_WRITE = 1_700_000_000     # modification time of the first slice on a local file system


def write_time_slices(readings: DataFrame, path: str, slices: int | None = None, time_col: str = "event_time",
                      sequential: bool | None = None, delivered: Column | None = None, first: int = 0) -> int:
    """Write readings as Kafka-shaped JSON text files, one per slice of their delivery times.

    ``delivered`` is the delivery time in microseconds (default: the event time; a later one plants readings that arrive
    out of order). The file source replays files in modification-time order. Slices hold equally many readings: rows are
    ranged by delivery time and id, so a burst is several slices. On a local file system one job writes all slices and
    their mtimes are then set in range order (part numbers follow the ranges). On shared storage the slices are appended
    one job after the other instead, so their write times follow the order (``sequential`` forces either way).
    ``slices`` defaults to six, or more so that a slice holds about ``SLICE_ROWS`` readings: one task writes a slice, so a
    fixed number of them grows with the input. A stream that wants fewer micro-batches takes several slices at a time
    (``per_trigger``). ``first`` numbers the slices of a further call with the same path, for streams that go on.
    """
    spark = readings.sparkSession
    if slices is None:
        slices = max(6, -(-readings.count() // SLICE_ROWS))
    us = epoch_micros(readings, time_col) if delivered is None else delivered
    env = ev.envelope(readings.withColumn("_us", us), carry=("event_id", "_us"))
    fields = [c for c in env.columns if c not in ("event_id", "_us")]
    line = F.to_json(F.struct(F.col("event_id").cast("string").alias("key"),
                              F.to_json(F.struct(*fields)).alias("value")))
    local = is_local_path(spark, path)
    sequential = not local if sequential is None else sequential
    if not sequential and not local:
        raise ValueError("modification times can only be set on a local path; use sequential=True")
    ordered = env.select(line.alias("value"), "_us", "event_id").repartitionByRange(slices, "_us", "event_id")
    if not sequential:
        base = local_fs_path(path)
        known = set(os.listdir(base)) if os.path.isdir(base) else set()
        ordered.sortWithinPartitions("_us", "event_id").select("value").write.mode("append").text(path)
        files = sorted(f for f in os.listdir(base) if f.startswith("part-") and f not in known)
        for i, f in enumerate(files):
            os.utime(os.path.join(base, f), (_FIRST_WRITE + first + i,) * 2)
        return len(files)
    # the ranges are written once, so that every slice is cut from the same ones; a folder each, so a slice reads its own only
    ranged_path = scratch_path(spark, "scarp", "ranged")
    ordered.select("value", F.spark_partition_id().alias("_slice")).write.partitionBy("_slice").parquet(ranged_path)
    ranged = spark.read.schema("value string, _slice int").parquet(ranged_path)
    for k in range(slices):
        ranged.where(F.col("_slice") == k).select("value").coalesce(1).write.mode("append").text(path)
    return slices


def per_trigger(slices: int, batches: int) -> int:
    """Slices a trigger takes so that ``slices`` of them are read in ``batches`` micro-batches."""
    return max(1, -(-slices // batches))
