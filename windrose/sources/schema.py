"""Typed schemas of the event envelope, its payload and the driver tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values of the data model: the three event families in emission order
# and the payload defaults.
SOURCES = ("sensor", "log", "feed")
DEFAULT_SOURCE = "feed"
DEFAULT_EVENT_TYPE = "raw"
UNKNOWN_LABEL = "UNKNOWN"
SENSOR_METRIC = "sensor.value"
AGGREGATION_NAME = {"sensor": "avg", "log": "count_by_level", "feed": "count_by_action"}

# One superset payload for all families; every field nullable, read with
# from_json (no inference), so a JSON 1 or "true" in `success` becomes null.
PAYLOAD_SCHEMA = T.StructType([
    T.StructField("level", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("service", T.StringType()),
    T.StructField("host", T.StringType()),
    T.StructField("sensor_id", T.StringType()),
    T.StructField("metric", T.StringType()),
    T.StructField("unit", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("action", T.StringType()),
    T.StructField("resource", T.StringType()),
    T.StructField("success", T.BooleanType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
])

EVENT_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("payload", PAYLOAD_SCHEMA),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
    T.StructField("correlation_id", T.StringType()),
    T.StructField("arrival_seq", T.LongType()),
])

# Wire form of an event as JSON lines: payload kept as raw JSON text so that
# key presence can still be told from null.
RAW_EVENT_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("payload", T.StringType()),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
    T.StructField("correlation_id", T.StringType()),
    T.StructField("arrival_seq", T.LongType()),
])

# The driver's `events` table.
DRIVER_EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])
