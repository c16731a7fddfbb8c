"""Inputs of the named queries that the driver's tables do not hold, derived from
``events`` by fixed rules (FIXTURES.md): the processing ledger and wire events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windrose.functions.scalar import bool_text, iso_utc
from windrose.sources.ingest import ledger_from_times, load_signal

# Fixed values of the ledger rule (FIXTURES.md §2.2).
_LATENCY_PER_K = 7.0
_LATENCY_MOD = 13
_DROP_FROM_K = 95


def is_dropped(k: Column) -> Column:
    return F.coalesce(k >= _DROP_FROM_K, F.lit(False))


def handled(signal: DataFrame) -> DataFrame:
    """The signal frame with a received and a processed time and a drop flag."""
    lat = F.col("k") * F.lit(_LATENCY_PER_K) + (F.col("event_id") % _LATENCY_MOD)
    return signal.withColumns({
        "received_at": F.col("ts"), "processed_at": F.timestamp_micros(F.col("t_us") + (lat * 1000).cast("long")),
        "dropped": is_dropped(F.col("k"))})


def ledger(signal: DataFrame) -> DataFrame:
    """Per-event processing record of the fixture."""
    return ledger_from_times(handled(signal), keep=("event_id", "arrival_seq", "source", "t_us"))


def load_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger(load_signal(spark, sf_dir))


def processed_signal(signal: DataFrame) -> DataFrame:
    """The events that reach the processor (the ledger's rows with ``dropped = false``)."""
    return signal.filter(~is_dropped(F.col("k")))


# Fixed values of the wire rule (FIXTURES.md §2.3).
_BROKEN_EVERY = 50       # event_id % 50 == 0: the payload is cut off
_OWN_TAGS_EVERY = 7      # event_id % 7 == 0: the producer sends tags of its own
_SERVICES, _PLACES = 5, 11


def wire_lines(signal: DataFrame) -> DataFrame:
    """(line): every event as one JSON line of the wire, with all payload fields of its
    family, fields the schema does not know, and broken payloads."""
    src, uid = F.col("source"), F.col("user_id").cast("string")
    name = lambda prefix, n: F.concat(F.lit(prefix), (F.col("event_id") % n).cast("string"))
    extra = F.struct((F.col("event_id") % 3).alias("shard"), F.array(F.col("k"), F.lit(1)).alias("path"))
    log = F.struct("level", name("message ", 9).alias("message"), name("svc-", _SERVICES).alias("service"),
                   name("host-", 3).alias("host"), extra.alias("extra"))
    sensor = F.struct(uid.alias("sensor_id"), name("metric-", 4).alias("metric"), "value", F.lit("C").alias("unit"),
                      name("room ", _PLACES).alias("location"), extra.alias("extra"))
    feed = F.struct(uid.alias("user_id"), "action", name("/page/", _PLACES).alias("resource"), "success",
                    iso_utc("ts").alias("timestamp"), extra.alias("extra"))
    payload = F.when(src == "log", F.to_json(log)).when(src == "sensor", F.to_json(sensor)).otherwise(F.to_json(feed))
    payload = F.when(F.col("event_id") % _BROKEN_EVERY == 0, F.substring(payload, 1, 12)).otherwise(payload)
    tags = F.when(F.col("event_id") % _OWN_TAGS_EVERY == 0,
                  F.create_map(F.lit("level"), F.lit("given"), F.lit("success"), bool_text(F.col("k") > 50)))
    return signal.select(F.to_json(F.struct(
        F.col("event_id").cast("string").alias("id"), src.alias("source"), iso_utc("ts").alias("timestamp"),
        payload.alias("payload"), tags.alias("tags"), "arrival_seq")).alias("line"))
