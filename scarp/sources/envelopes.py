"""Envelope sources and sinks: Kafka (as the reference), or files for tests.

The Kafka connector jar is not bundled; ``format="kafka"`` only needs it on
the cluster's classpath. Files (json lines / text / parquet) go through the
same parse path, so tests exercise the real operators.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import features as fx
from ..functions import parse as ps

_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def read_envelopes(spark: SparkSession, format: str = "kafka", *, path: str | None = None,
                   servers: str | None = None, topic: str | None = None,
                   starting_offsets: str = "latest", fail_on_data_loss: bool | None = None,
                   stream: bool = True, schema=None, options: dict[str, str] | None = None) -> DataFrame:
    """Raw messages with a ``value`` column (binary for Kafka, string for text files).

    Kafka keeps ``key, topic, partition, offset, timestamp`` too; (partition,
    offset) is the arrival order that a tie-break may use.
    """
    reader = spark.readStream if stream else spark.read
    opts = dict(options or {})
    if format == "kafka":
        opts.setdefault("kafka.bootstrap.servers", servers or "localhost:9092")
        opts.setdefault("subscribe", topic or "landslide_data")
        if stream:
            opts.setdefault("startingOffsets", starting_offsets)
        if fail_on_data_loss is not None:
            opts["failOnDataLoss"] = str(bool(fail_on_data_loss)).lower()
        return reader.format("kafka").options(**opts).load()
    if format in ("json", "text"):
        # one JSON document per line, kept as text so from_json sees the raw message
        return reader.options(**opts).text(path)
    if format == "parquet":
        r = reader.options(**opts)
        if schema is not None:
            r = r.schema(schema)
        return r.parquet(path)
    raise ValueError(f"unsupported envelope format: {format}")


def _digits(node: Column, kind: T.DataType, digits: int) -> Column:
    """A number, or every number of a struct, rounded."""
    if isinstance(kind, T.StructType):
        return F.when(node.isNotNull(), F.struct(*[_digits(node[f.name], f.dataType, digits).alias(f.name) for f in kind.fields]))
    return F.round(node, digits)


def round_packet(env: DataFrame) -> DataFrame:
    """Envelopes with every measured value rounded to the digits its sensor publishes (``features.PACKET_DIGITS``)."""
    kind = env.schema["value"].dataType
    fields = [_digits(F.col("value")[f.name], f.dataType, fx.PACKET_DIGITS[f.name]).alias(f.name) for f in kind.fields]
    return env.withColumn("value", F.struct(*fields))


def envelope(readings: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Flat readings -> nested envelope columns as the sensors publish them.

    NULL members are left out of the JSON text, so each packet carries only its
    own sensor's fields. Event time is written as naive ISO-8601 text.
    """
    x, y = fx.planar_xy("latitude", "longitude")
    is_imu = F.col("sensor_type") == "imu"
    roll, pitch = fx.tilt("acc_x", "acc_y", "acc_z")
    value = F.struct(
        F.when(is_imu, F.struct(F.col("vx").alias("x"), F.col("vy").alias("y"))).alias("velocity"),
        F.when(is_imu, F.struct(F.col("acc_x").alias("x"), F.col("acc_y").alias("y"),
                                F.col("acc_z").alias("z"), F.col("acc_rms").alias("rms"))).alias("acceleration"),
        F.when(is_imu, F.struct(roll.alias("roll"), pitch.alias("pitch"))).alias("tilt"),
        F.col("intensity").alias("intensity"),
        F.col("water_level").alias("water_level"),
        F.col("pore_pressure").alias("pore_pressure"),
        F.col("latitude").alias("latitude"),
        F.col("longitude").alias("longitude"),
        F.when(F.col("sensor_type") == "gnss",
               F.struct(fx.packet_round(x, "vn2000").alias("x"),
                        fx.packet_round(y, "vn2000").alias("y"))).alias("vn2000"),
    )
    return readings.select(
        *carry,
        F.date_format("event_time", _TS_FORMAT).alias("timestamp"),
        "cluster_id", "sensor_id", "sensor_type",
        ps.topic("cluster_id", "sensor_type").alias("mqtt_topic"),
        value.alias("value"),
    )


def encode_envelopes(readings: DataFrame, key_col: str | None = "event_id", rounded: bool = False) -> DataFrame:
    """Serialise readings to Kafka-shaped rows ``(key, value)`` with JSON text values.

    ``rounded`` publishes the digits the sensors publish; by default values keep all of theirs.
    """
    carry = (key_col,) if key_col else ()
    env = envelope(readings, carry=carry)
    env = round_packet(env) if rounded else env
    fields = [c for c in env.columns if c not in carry]
    value = F.to_json(F.struct(*fields)).alias("value")
    if key_col:
        return env.select(F.col(key_col).cast("string").alias("key"), value)
    return env.select(value)


def write_envelopes(df: DataFrame, format: str = "kafka", *, path: str | None = None,
                    servers: str | None = None, topic: str | None = None,
                    checkpoint: str | None = None, options: dict[str, str] | None = None,
                    trigger: dict | None = None):
    """Sink for encoded envelopes: Kafka topic, or text files (one JSON per line).

    A stream starts with ``trigger`` (e.g. ``{"availableNow": True}``) and its query is returned.
    """
    opts = dict(options or {})
    if df.isStreaming:
        w = (df if format == "kafka" else df.select("value")).writeStream
        if trigger:
            w = w.trigger(**trigger)
        if checkpoint:
            w = w.option("checkpointLocation", checkpoint)
        if format == "kafka":
            opts.setdefault("kafka.bootstrap.servers", servers or "localhost:9092")
            opts.setdefault("topic", topic or "landslide_data")
            return w.format("kafka").options(**opts).start()
        return w.format("text").options(**opts).start(path)
    if format == "kafka":
        opts.setdefault("kafka.bootstrap.servers", servers or "localhost:9092")
        opts.setdefault("topic", topic or "landslide_data")
        return df.write.format("kafka").options(**opts).save()
    return df.select("value").write.mode("overwrite").options(**opts).text(path)
