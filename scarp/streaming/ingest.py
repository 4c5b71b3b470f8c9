"""Ingest: every message parsed once and kept once, as a reading, as a late reading or as a rejected message.

The engine drops what misses the watermark and what cannot be parsed. Here a first query parses the messages and writes
each micro-batch, in one job, into three tables under one folder:

* ``on_time`` - readings whose window is still open;
* ``late`` - readings whose window the watermark has passed (the newest event time of the earlier batches less the delay);
* ``rejected`` - messages that are no reading, with the text and the reason.

Fields that the schema does not know, and known ones of another type, are kept as JSON text beside the row that held them
(``drift``); ``drifted`` lists them by path.

Aggregations read ``on_time`` as a stream (``reading_stream``) and miss nothing: a row that is on time here is on time
there. ``reconcile`` aggregates the windows that late readings touched anew, from both tables, and upserts them as newer
versions. ``quarantined`` gives the rejected messages back as messages, to be repaired and sent again.

A batch is written to a staging folder and then published day by day by renaming, older days first. A batch that is
replayed after a failure finds what is published already and leaves it, so a stream that reads the table never sees a
row twice. The watermark of a batch depends on the earlier batches only (``_progress``), so a replay decides alike.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import parse as ps
from ..operators.sequence import duration_us
from ..plans import alerts as al
from . import files
from .sink import PointsWriter

KINDS = ("on_time", "late", "rejected")
FEATURES = ("event_time timestamp, sensor_id string, cluster_id string, sensor_type string, imu_velocity double, acc_rms double, "
            "rain double, pressure double, gnss_x double, gnss_y double, msg_id long")
_DRIFT = "drift array<struct<path:string,type:string,value:string>>"
_PLACE = "date string, run int, batch long"


def feature_names() -> list[str]:
    return [part.split()[0] for part in FEATURES.split(", ")]


def window_start_us(every: str) -> Column:
    width = duration_us(every)
    return F.floor(F.unix_micros("event_time") / F.lit(width)).cast("long") * F.lit(width)


class Ingest:
    """``foreachBatch`` callback: messages -> the three tables under ``base``."""

    def __init__(self, base: str, watermark: str = "10 seconds", every: str = "1 second"):
        self.base, self.delay_us, self.every = base.rstrip("/"), duration_us(watermark), every
        self.run: int | None = None

    def _progress(self, batch_id: int) -> str:
        return f"{self.base}/_progress/run={self.run}/batch={batch_id}"

    def _newest_before(self, spark: SparkSession, batch_id: int) -> int | None:
        """Newest event time (microseconds) of the batches before this one."""
        if batch_id == 0:
            return None
        return spark.read.schema("newest long").json(self._progress(batch_id - 1)).first()["newest"]

    def __call__(self, messages: DataFrame, batch_id: int) -> None:
        spark = messages.sparkSession
        if self.run is None:
            self.run = files.claim_number(spark, f"{self.base}/_runs", spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "manual")
        newest = self._newest_before(spark, batch_id)
        # whole milliseconds, as the engine's watermark
        passed = None if newest is None else newest // 1000 * 1000 - self.delay_us
        staged = f"{self.base}/_staging/run={self.run}/batch={batch_id}"
        self._rows(messages, passed).write.mode("overwrite").partitionBy("kind", "date").parquet(staged)
        written = files.stored(spark, staged)
        if written is not None:
            top = written.where(F.col("kind") != "rejected").agg(F.max(F.unix_micros("event_time"))).first()[0]
            newest = max(filter(lambda v: v is not None, (newest, top)), default=None)
        # the progress comes before the rows: a replay of the next batch needs it, a replay of this one writes it anew
        spark.range(1).select(F.lit(newest).cast("long").alias("newest")).write.mode("overwrite").json(self._progress(batch_id))
        for kind in KINDS:
            for date in files.folders(spark, f"{staged}/kind={kind}"):
                files.publish(spark, f"{staged}/kind={kind}/{date}", f"{self.base}/{kind}/{date}/run={self.run}/batch={batch_id}")
        files.remove(spark, staged)

    def _rows(self, messages: DataFrame, passed: int | None) -> DataFrame:
        from .jobs import with_message_id
        tagged = ps.tag_messages(messages, keep=("key",), ntz=False, drift=True)
        features = ps.envelope_features(tagged.withColumnRenamed("reason", "_reason"), ntz=False, keep=("key", "raw", "_reason", "drift"))
        rows = with_message_id(features.withColumn("message_key", F.col("key")))          # the id is a hash where there is no key
        rejected = F.col("_reason").isNotNull()
        late = F.lit(False) if passed is None else window_start_us(self.every) + F.lit(duration_us(self.every)) <= F.lit(passed)
        kind = F.when(rejected, "rejected").when(late, "late").otherwise("on_time")
        return rows.select(*feature_names(), "drift", F.when(rejected, F.col("message_key")).alias("message_key"), F.when(rejected, F.col("raw")).alias("raw"),
                           F.col("_reason").alias("reason"), kind.alias("kind"),
                           F.when(rejected, F.lit("none")).otherwise(F.date_format("event_time", "yyyy-MM-dd")).alias("date"))


def start_ingest_job(messages: DataFrame, base: str, checkpoint: str, watermark: str = "10 seconds", every: str = "1 second",
                     trigger: dict | None = None) -> StreamingQuery:
    """Messages ``(key, value)`` -> the tables ``on_time``, ``late`` and ``rejected`` under ``base``."""
    w = (messages.writeStream.foreachBatch(Ingest(base, watermark, every)).option("checkpointLocation", checkpoint))
    return w.trigger(**(trigger or {"processingTime": "1 second"})).start()


def reading_stream(spark: SparkSession, base: str) -> DataFrame:
    """The readings that came in time, as a stream of features.

    All new files are taken at once: a micro-batch never splits an ingested one, in which readings may be out of order by
    more than the watermark's delay.
    """
    return spark.readStream.schema(f"{FEATURES}, {_PLACE}").parquet(f"{base}/on_time").select(*feature_names())


def readings(spark: SparkSession, base: str, kind: str) -> DataFrame:
    """One of the three tables, with the place of every row (``date``, ``run``, ``batch``)."""
    extra = f", {_DRIFT}" + (", message_key string, raw string, reason string" if kind == "rejected" else "")
    if not files.exists(spark, f"{base}/{kind}"):            # nothing of the kind so far
        return spark.createDataFrame([], f"{FEATURES}{extra}, {_PLACE}")
    return spark.read.schema(f"{FEATURES}{extra}, {_PLACE}").parquet(f"{base}/{kind}")


def quarantined(spark: SparkSession, base: str, *reasons: str) -> DataFrame:
    """Rejected messages as ``(key, value, reason)``, of the given reasons or all: to be mended and sent again."""
    rows = readings(spark, base, "rejected")
    rows = rows.where(F.col("reason").isin(*reasons)) if reasons else rows
    return rows.select(F.col("message_key").alias("key"), F.col("raw").alias("value"), "reason")


def drifted(spark: SparkSession, base: str) -> DataFrame:
    """``path, type, n, first_seen`` of the fields in stored readings that the schema does not know or expects otherwise."""
    return ps.drift_table(readings(spark, base, "on_time").unionByName(readings(spark, base, "late")))


_BATCHES = 1 << 40


def reconcile(spark: SparkSession, base: str, points_path: str, every: str = "1 second") -> int:
    """Aggregate the windows that late readings touched since the last call anew and upsert them as newer versions.

    Reads the days of those windows only, reduced to them before the aggregation. Returns the number of late readings
    taken in. Call it again after an aggregation has been started anew from a fresh checkpoint (``since`` is kept in
    ``_reconciled``: remove that folder to take all late readings again).
    """
    place = F.col("run").cast("long") * F.lit(_BATCHES) + F.col("batch")
    since = None
    if files.exists(spark, f"{base}/_reconciled"):
        since = spark.read.schema("upto long").json(f"{base}/_reconciled").agg(F.max("upto")).first()[0]
    late = readings(spark, base, "late")
    new = late if since is None else late.where(place > F.lit(since))
    n, upto = new.agg(F.count(F.lit(1)), F.max(place)).first()
    if not n:
        return 0
    touched = new.select("date", "cluster_id", window_start_us(every).alias("_start")).distinct()
    days = [r[0] for r in touched.select("date").distinct().collect()]         # a handful: the days late readings fell on
    rows = readings(spark, base, "on_time").unionByName(late).where(F.col("date").isin(*days)).withColumn("_start", window_start_us(every))
    rows = rows.join(touched, ["date", "cluster_id", "_start"], "left_semi").select(*feature_names())
    alerts = al.monitoring_alerts(rows, every=every, tie_col="msg_id")
    # a run of its own, numbered after all that have written so far
    PointsWriter(points_path, query_id=f"reconcile-{uuid.uuid4().hex}")(alerts, 0)
    files.create_if_absent(spark, f"{base}/_reconciled/{uuid.uuid4().hex}.json", json.dumps({"upto": upto}) + "\n")
    return n
