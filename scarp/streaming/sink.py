"""Micro-batch sink: points upsert, alert log and batch audit, fully distributed.

The reference collects each micro-batch to the driver and loops over rows;
here the executors write every batch under ``date=D/run=R/batch=B``. ``R``
numbers the checkpoints that have written to the table, in the order of their
first batch, so a fresh checkpoint never touches rows that are stored, and
``(run, batch)`` orders all versions of a key. A replayed batch overwrites its
own directories only. Readers take the newest version of each key;
``compact_points`` rewrites a table to one version per key.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import model
from ..operators.series import to_points
from . import files

POINT_KEYS = ("time", "cluster_id")
VERSION = ("date", "run", "batch")
# a run holds fewer batches than this (at one a second: 34,000 years)
_BATCHES = 1 << 40


def run_number(spark: SparkSession, path: str, query_id: str) -> int:
    """Number of the checkpoint ``query_id`` among those that wrote to ``path`` (claimed on first use).

    One file per run in ``path/_runs``, which table reads skip; it is created if absent, so queries that start
    together never share a run and never overwrite each other's batches.
    """
    return files.claim_number(spark, f"{path}/_runs", query_id)


class PointsWriter:
    """``foreachBatch`` callback: alert rows -> points table + alert log + audit row.

    The alert log holds raised windows and, when a later batch lowers a window
    that was raised, a row with the lower level: its newest version tells
    whether an alert stands. Errors propagate (the batch is retried, not
    silently committed). The batch is persisted once so points and alerts are
    not computed twice.
    """

    def __init__(self, points_path: str, alerts_path: str | None = None, audit_path: str | None = None,
                 zero_fill: bool = False, query_id: str | None = None):
        self.points_path = points_path.rstrip("/")
        self.alerts_path = alerts_path.rstrip("/") if alerts_path else None
        self.audit_path = audit_path.rstrip("/") if audit_path else None
        self.zero_fill = zero_fill
        self.query_id = query_id
        self.run: int | None = None

    def _run(self, spark: SparkSession) -> int:
        if self.run is None:
            query = self.query_id or spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "manual"
            self.run = run_number(spark, self.points_path, query)
        return self.run

    def _write(self, df: DataFrame, path: str, run: int, batch_id: int) -> None:
        # date comes first, so a time range prunes whole days before any batch is listed
        (df.withColumns({"run": F.lit(run), "batch": F.lit(int(batch_id))})
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*VERSION).parquet(path))

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        pts = to_points(batch_df, zero_fill=self.zero_fill)
        pts = pts.select("*", F.to_date("time").alias("date"))
        # the state store deals the rows to as many tasks as it has partitions; a task then writes one file per date
        pts = pts.repartition("date", F.pmod(F.xxhash64(*POINT_KEYS), F.lit(4))).persist()
        try:
            # one full pass fills the cache and gives exact counts (T6)
            n, n_alerts = pts.agg(F.count(F.lit(1)), F.count(F.when(F.col("alert_level") > 1, 1))).first()
            if n == 0:
                return                                  # empty micro-batch: nothing written
            run = self._run(spark)
            self._write(pts, self.points_path, run, batch_id)
            if self.alerts_path:
                self._log_alerts(pts, run, batch_id)
            self.written(pts, run, batch_id)
            if self.audit_path:
                # one audit row, built JVM-side (no Python data shipped)
                (spark.range(1)
                 .select(F.lit(int(batch_id)).alias("batch_id"), F.lit(int(n)).alias("points"),
                         F.lit(int(n_alerts)).alias("alerts"))
                 .write.mode("overwrite").parquet(f"{self.audit_path}/run={run}/batch={batch_id}"))
        finally:
            pts.unpersist()

    def written(self, pts: DataFrame, run: int, batch_id: int) -> None:
        """Called with the cached points of a batch once they are stored."""

    def _log_alerts(self, pts: DataFrame, run: int, batch_id: int) -> None:
        rows = pts.select(*POINT_KEYS, "alert_level", "date")
        logged = files.stored(pts.sparkSession, self.alerts_path)
        changed = rows.where(F.col("alert_level") > 1)
        if logged is not None:
            # this batch's own rows are from an earlier try: they are written anew
            # only the days of this batch are read; the log as a whole grows without end
            days = [r[0] for r in rows.select("date").distinct().collect()]
            older = logged.where(F.col("date").isin(*days) & ~((F.col("run") == run) & (F.col("batch") == int(batch_id))))
            raised = (newest(older).where(F.col("alert_level") > 1).select(*POINT_KEYS, "date"))
            lowered = rows.where(F.col("alert_level") <= 1).join(raised, [*POINT_KEYS, "date"], "left_semi")
            changed = changed.unionByName(lowered)
        self._write(changed, self.alerts_path, run, batch_id)


def newest(versions: DataFrame, keys: Sequence[str] = POINT_KEYS) -> DataFrame:
    """Newest version of every key; ``max_by`` on one numeric version keeps hash aggregation for numeric fields."""
    group = [*keys, *(["date"] if "date" in versions.columns and "date" not in keys else [])]
    cols = [c for c in versions.columns if c not in group and c not in VERSION]
    version = F.col("run").cast("long") * F.lit(_BATCHES) + F.col("batch")
    return versions.groupBy(*group).agg(*[F.max_by(c, version).alias(c) for c in cols])


def read_latest(spark: SparkSession, path: str, keys: Sequence[str] = POINT_KEYS) -> DataFrame:
    """Newest version of every key across all runs and batches.

    ``date`` (derived from ``time``) is grouped on as well, which changes no
    result but lets a filter on ``date`` pass the aggregate and prune
    partitions at the scan (see ``series.time_range``).
    """
    return newest(spark.read.parquet(path), keys)


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """Alerts that stand: the newest row of each window in the log, where it is raised."""
    level = F.col("alert_level").cast("int")
    return read_latest(spark, path).where(F.col("alert_level") > 1).withColumn("alert_message", model.alert_message(level))


def compact_points(spark: SparkSession, path: str, out: str, keys: Sequence[str] = POINT_KEYS,
                   since: str | None = None) -> None:
    """Write the newest version of every key of ``path`` to the fresh table ``out`` (run 0), optionally only days
    from ``since`` on (retention). Point readers and the writer at ``out`` afterwards; versions written there rank
    above the compacted rows."""
    latest = read_latest(spark, path, keys)
    if since is not None:
        latest = latest.where(F.col("date") >= F.lit(since).cast("date"))
    (latest.withColumns({"run": F.lit(0), "batch": F.lit(0)}).repartition("date")
     .write.partitionBy(*VERSION).parquet(out))


try:
    from pyspark.sql.streaming import StreamingQueryListener
except ImportError:  # pragma: no cover
    StreamingQueryListener = object


class AuditListener(StreamingQueryListener):
    """Collects each batch's observed metrics (``observe`` on the stream) on the driver.

    Holds one small dict for each of the last ``keep`` micro-batches: batch id,
    input rows, and the named observations, e.g. the monitoring job's
    ``alert_rows`` (rows, alerts).
    """

    def __init__(self, name: str = "alert_rows", keep: int = 1000):
        self.name = name
        self.batches: deque[dict] = deque(maxlen=keep)

    def onQueryStarted(self, event):  # noqa: N802
        pass

    def onQueryProgress(self, event):  # noqa: N802
        p = event.progress
        obs = p.observedMetrics.get(self.name)
        self.batches.append({"batch_id": p.batchId, "input_rows": p.numInputRows,
                             **(obs.asDict() if obs is not None else {})})

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        pass
