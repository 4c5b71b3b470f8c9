"""JSON envelope parsing, field projection, cluster and topic helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import ENVELOPE_SCHEMA
from . import features as fx

# Cluster id pattern, topic layout, fallback tag.
CLUSTER_PATTERN = r"(cluster_\d+)"
TOPIC_ROOT = "sensors"
UNKNOWN_CLUSTER = "unknown"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _parsed_once(df: DataFrame, text, schema: T.StructType, keep: tuple[str, ...], raw: bool = False) -> DataFrame:
    """``data`` = the parsed struct, produced by a generator.

    A filter on parsed fields (the reject test, the window's NOT NULL on event
    time) would otherwise be pushed below the projection and rewritten onto
    each field, re-parsing the text once per field. Predicates are not pushed
    below a generator, so exploding a one-element array parses every message
    exactly once.
    """
    extra = [text.alias("raw")] if raw else []
    return df.select(*keep, *extra, F.explode(F.array(F.from_json(text, schema))).alias("data"))


def parse_json(df: DataFrame, value_col: str = "value", schema: T.StructType = ENVELOPE_SCHEMA,
               keep: tuple[str, ...] = ()) -> DataFrame:
    """Binary/string payload -> envelope columns (``data.*``), keeping ``keep`` columns.

    PERMISSIVE ``from_json``: text that is not a JSON object gives an all-NULL
    row, a wrongly typed field gives NULL for that field only.
    """
    return _parsed_once(df, F.col(value_col).cast("string"), schema, keep).select(*keep, "data.*")


# A zone at the end of a time of day: Z, +07, +0700 or +07:00.
_ZONED = r"\d{1,2}:\d{2}.*(Z|[+-]\d{2}(:?\d{2})?)$"


def parse_event_time(col, ntz: bool = True) -> Column:
    """ISO-8601 text -> timestamp; unparseable text gives NULL instead of failing (ANSI-safe).

    Batch paths keep TIMESTAMP_NTZ (no zone involved); streaming needs
    TIMESTAMP for watermarks, so ``ntz=False`` reads the text in the session
    zone. Text that names a zone is the same instant in both: it is converted
    to the session zone before the zone is dropped.
    """
    instant = _c(col).try_cast("timestamp")
    if not ntz:
        return instant
    return F.when(_c(col).rlike(_ZONED), instant.cast("timestamp_ntz")).otherwise(_c(col).try_cast("timestamp_ntz"))


def number(col) -> Column:
    """A measured value; NaN (which JSON text may carry) counts as missing.

    NaN compares above every number in Spark, so one NaN would raise false alerts.
    """
    return F.when(~F.isnan(_c(col)), _c(col))


def cluster_of(sensor_id) -> Column:
    """``cluster_<digits>`` inside a sensor id; '' when absent (NULL for NULL input)."""
    return F.regexp_extract(_c(sensor_id), CLUSTER_PATTERN, 1)


def resolve_cluster(payload_cluster, sensor_id) -> Column:
    """Payload cluster first, then the id pattern, then 'unknown'."""
    return F.coalesce(F.nullif(_c(payload_cluster), F.lit("")),
                      F.nullif(cluster_of(sensor_id), F.lit("")),
                      F.lit(UNKNOWN_CLUSTER))


def topic(cluster, sensor_type) -> Column:
    """Publish topic ``sensors/{cluster}/{type}``."""
    return F.concat_ws("/", F.lit(TOPIC_ROOT), _c(cluster), _c(sensor_type))


def topic_cluster(topic_col) -> Column:
    return F.split(_c(topic_col), "/").getItem(1)


def topic_sensor_type(topic_col) -> Column:
    return F.split(_c(topic_col), "/").getItem(2)


def envelope_features(parsed: DataFrame, ntz: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """Flat feature rows from parsed envelopes (the monitoring job's projection).

    Metric fields are taken by nested path; speed only for IMU packets.
    """
    return parsed.select(
        *keep,
        parse_event_time("timestamp", ntz).alias("event_time"),
        "sensor_id",
        resolve_cluster("cluster_id", "sensor_id").alias("cluster_id"),
        "sensor_type",
        F.when(F.col("sensor_type") == "imu",
               number(fx.speed_xy("value.velocity.x", "value.velocity.y"))).alias("imu_velocity"),
        number("value.acceleration.rms").alias("acc_rms"),
        number("value.intensity").alias("rain"),
        number("value.pore_pressure").alias("pressure"),
        number("value.vn2000.x").alias("gnss_x"),
        number("value.vn2000.y").alias("gnss_y"),
    )


def reject_reason(event_time, sensor_type, all_null) -> Column:
    """Why a parsed message cannot be used; NULL when it is good."""
    return (F.when(all_null, F.lit("unparseable"))
            .when(_c(event_time).isNull(), F.lit("missing_time"))
            .when(_c(sensor_type).isNull(), F.lit("missing_type")))


def tag_messages(df: DataFrame, value_col: str = "value", keep: tuple[str, ...] = (),
                 ntz: bool = True, drift: bool = False) -> DataFrame:
    """Parse raw messages once and attach ``reason`` (NULL for a usable message).

    ``drift`` parses to a variant instead and adds ``drift``: what the message holds beyond the schema (``drift_of``).
    A number written as text is then read as the number, and reported.
    """
    text = F.col(value_col).cast("string")
    extra = []
    if drift:
        # as in ``_parsed_once``: the generator keeps filters on parsed fields from parsing again
        once = df.select(*keep, text.alias("raw"), F.explode(F.array(F.try_parse_json(text))).alias("_v"))
        typed = [F.try_variant_get("_v", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in ENVELOPE_SCHEMA.fields]
        parsed = once.select(*keep, "raw", F.struct(*typed).alias("data"), drift_of("_v", ENVELOPE_SCHEMA).alias("drift"))
        extra = ["drift"]
    else:
        parsed = _parsed_once(df, text, ENVELOPE_SCHEMA, keep, raw=True)
    fields = [F.col(f"data.{f.name}") for f in ENVELOPE_SCHEMA.fields]
    all_null = ~F.greatest(*[f.isNotNull() for f in fields])
    return parsed.select(
        *keep, "raw", "data.*", *extra,
        reject_reason(parse_event_time("data.timestamp", ntz), "data.sensor_type", all_null).alias("reason"))


# Kinds of JSON values by the type names of variants.
_NUMBERS = ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT")


def _kind(v: Column) -> Column:
    name = F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)
    return F.when(name.isin(*_NUMBERS), "NUMBER").when(name == "VOID", "NULL").otherwise(name)


def _expected(kind: T.DataType) -> str:
    return {"struct": "OBJECT", "map": "OBJECT", "double": "NUMBER"}.get(kind.typeName(), "STRING")


def drift_of(v, schema: T.StructType = ENVELOPE_SCHEMA) -> Column:
    """What a variant holds beyond ``schema``: an array of ``(path, type, value)``, NULL when there is nothing.

    A field that the schema does not know is reported as a whole, under its path, with its JSON text; so is a known
    field of another kind (NUMBER, STRING, BOOLEAN, OBJECT, ARRAY; a null fits every field).
    """
    def strange(node: T.StructType, path: tuple[str, ...]) -> list[Column]:
        held = F.map_entries(F.try_variant_get(_c(v), ".".join(["$", *path]), "map<string,variant>"))
        known = F.create_map(*[F.lit(x) for f in node.fields for x in (f.name, _expected(f.dataType))])
        reported = F.transform(held, lambda e: F.struct(
            F.concat(F.lit("".join(p + "." for p in path)), e["key"]).alias("path"), _kind(e["value"]).alias("type"),
            F.to_json(e["value"]).alias("value"), F.try_element_at(known, e["key"]).alias("known")))
        odd = F.filter(reported, lambda e: e["known"].isNull() | ((e["known"] != e["type"]) & (e["type"] != "NULL")))
        lists = [F.transform(odd, lambda e: F.struct(e["path"].alias("path"), e["type"].alias("type"), e["value"].alias("value")))]
        for f in node.fields:
            if isinstance(f.dataType, T.StructType):
                lists += strange(f.dataType, (*path, f.name))
        return lists

    empty = F.array().cast("array<struct<path:string,type:string,value:string>>")
    found = F.concat(*[F.coalesce(part, empty) for part in strange(schema, ())])
    return F.when(F.size(found) > 0, found)


def drift_table(rows: DataFrame, time_col: str = "event_time") -> DataFrame:
    """``path, type, n, first_seen`` of everything the rows' ``drift`` reports."""
    each = rows.where(F.col("drift").isNotNull()).select(F.col(time_col).alias("_t"), F.inline("drift"))
    return each.groupBy("path", "type").agg(F.count(F.lit(1)).alias("n"), F.min("_t").alias("first_seen"))


def split_rejected(df: DataFrame, value_col: str = "value", keep: tuple[str, ...] = (),
                   ntz: bool = True) -> tuple[DataFrame, DataFrame]:
    """Parse and split into (good features, rejected messages with a reason).

    Both outputs come from one parsed plan; persist the input if both are consumed.
    """
    tagged = tag_messages(df, value_col, keep, ntz)
    good = envelope_features(tagged.where(F.col("reason").isNull()), ntz=ntz, keep=keep)
    rejected = tagged.where(F.col("reason").isNotNull()).select(*keep, "raw", "reason")
    return good, rejected


def add_topic(df: DataFrame, cluster_col: str = "cluster_id", type_col: str = "sensor_type",
              out: str = "mqtt_topic") -> DataFrame:
    """Attach the publish topic ``sensors/{cluster}/{type}`` to every record."""
    return df.withColumn(out, topic(cluster_col, type_col))


def split_topic(df: DataFrame, topic_col: str = "mqtt_topic") -> DataFrame:
    """Add ``topic_cluster`` and ``topic_type`` taken from the topic path."""
    return df.withColumns({"topic_cluster": topic_cluster(topic_col), "topic_type": topic_sensor_type(topic_col)})
