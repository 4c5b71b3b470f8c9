"""Standing views beside a points table, kept current by its sink: roll-ups, newest points, tag values.

After each micro-batch only what it touched is brought up to date: the 10-s windows of its points are built anew from the
newest point versions of those windows, the 5-min windows from the 10-s states, and one small row per tag goes to the
views of newest points and tags. Everything is written as versions under ``date=D/run=R/batch=B``, like the points, so a
replayed batch overwrites itself and readers take the newest version; a day that no batch touches is never read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import rollup as ru
from ..operators import series as se
from ..operators.resample import epoch_micros
from ..operators.sequence import duration_us
from . import files
from .sink import PointsWriter, newest

LEVELS = ("10 seconds", "5 minutes")
_KEYS = ["cluster_id", "field"]


def _folder(base: str, every: str) -> str:
    return f"{base}/rollup_{every.replace(' ', '_')}"


class ViewsWriter(PointsWriter):
    """A points sink that also keeps the views under ``views_path``."""

    def __init__(self, points_path: str, views_path: str, alerts_path: str | None = None, audit_path: str | None = None, query_id: str | None = None):
        super().__init__(points_path, alerts_path, audit_path, query_id=query_id)
        self.views_path = views_path.rstrip("/")

    def written(self, pts: DataFrame, run: int, batch_id: int) -> None:
        spark = pts.sparkSession
        # one row per tag and day: enough for the newest point and for the tags seen in a range
        ranked = F.max_by(F.struct("alert_level"), epoch_micros(pts, "time"))
        last = pts.groupBy("cluster_id", "date").agg(F.max("time").alias("time"), ranked.alias("_n"))
        self._write(last.select("cluster_id", "date", "time", "_n.alert_level"), f"{self.views_path}/newest", run, batch_id)
        finer = None
        for every in LEVELS:
            width = F.lit(duration_us(every))
            at = F.floor(epoch_micros(pts, "time") / width).cast("long") * width
            touched = pts.select("cluster_id", "date", at.alias("at")).distinct()
            days = [r[0] for r in touched.select("date").distinct().collect()]        # the days of one micro-batch
            if finer is None:
                stored = newest(files.stored(spark, self.points_path).where(F.col("date").isin(*days)))
                states = ru.point_states(ru.points_in_windows(stored, touched, every))
            else:
                stored = newest(files.stored(spark, _folder(self.views_path, finer)).where(F.col("date").isin(*days)), (*_KEYS, "at"))
                states = stored.withColumn("_at", F.col("at")).withColumn("at", F.floor(F.col("_at") / width).cast("long") * width)
                states = states.join(touched, ["cluster_id", "at", "date"], "left_semi").drop("at", "date").withColumnRenamed("_at", "at")
            rows = ru.compose(states, every)
            rows = rows.withColumn("date", F.to_date(F.timestamp_micros("at")))
            self._write(rows, _folder(self.views_path, every), run, batch_id)
            finer = every


def read_rollup(spark: SparkSession, views_path: str, every: str) -> DataFrame:
    """Newest states of one level (``operators.rollup``)."""
    return newest(spark.read.parquet(_folder(views_path, every)), (*_KEYS, "at"))


def read_newest(spark: SparkSession, views_path: str, since: str | None = None) -> DataFrame:
    """Newest point (``time``, ``alert_level``) of every tag, optionally only where it lies within ``since`` of the newest of all.

    One row per tag, day and batch is read, and only from the days of the range.
    """
    view = spark.read.parquet(f"{views_path}/newest")
    if since is not None:
        view = se.time_range(view, since)
    # a later batch of the same instant has the newer version of that point
    order = F.struct(F.col("time"), F.col("run").cast("long") * F.lit(1 << 40) + F.col("batch"))
    return view.groupBy("cluster_id").agg(F.max("time").alias("time"), F.max_by("alert_level", order).alias("alert_level"))


def read_tags(spark: SparkSession, views_path: str, since: str = "30 days") -> DataFrame:
    """Tags that have a point within ``since`` of the newest one."""
    return read_newest(spark, views_path, since).select("cluster_id")
