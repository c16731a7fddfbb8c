"""Readers and envelope construction.

Two representations are used:

* the **envelope** (``EVENT_SCHEMA``): id, source, event_type, timestamp,
  typed payload struct, tags map, correlation id, arrival sequence;
* the flat **signal** frame: one column per payload field in use.  Plans run
  on the flat form so Parquet can prune columns and push filters; the
  envelope is the interchange form at sources and sinks.

All functions are column expressions over the input frame, so they work
unchanged on ``spark.readStream`` frames.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Optional

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windrose.functions.scalar import bool_text, iso_utc, latency_ms, string_map
from windrose.session import prepare_session
from windrose.sources.schema import (DEFAULT_EVENT_TYPE, DEFAULT_SOURCE,
                                     DRIVER_EVENTS_SCHEMA, PAYLOAD_SCHEMA,
                                     RAW_EVENT_SCHEMA)


# --------------------------------------------------------------------------
# Driver tables
# --------------------------------------------------------------------------

def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(prepare_session(spark), sf_dir, "events")


def stream_events(spark: SparkSession, sf_dir: str, max_files_per_trigger: Optional[int] = None) -> DataFrame:
    """The driver's ``events`` table as a file stream (read once with availableNow),
    whether it is one file or a folder of part files."""
    reader = prepare_session(spark).readStream.schema(DRIVER_EVENTS_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    table = f"{sf_dir.rstrip('/')}/events.parquet"
    path = spark._jvm.org.apache.hadoop.fs.Path(table)
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if files.getFileStatus(path).isDirectory():
        return reader.parquet(table)
    return reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)


# The derivation rule of the driver's events into the three
# event families (see FIXTURES.md §2.1).
_SOURCE_OF_TYPE = {"view": "sensor", "error": "log"}   # every other type is feed
_LEVEL_CUTS = ((40, "DEBUG"), (75, "INFO"), (90, "WARNING"), (98, "ERROR"))
_LEVEL_TOP = "CRITICAL"
_MISSING_LABEL_EVERY = 25      # k % 25 == 0 leaves level / action out
_SUCCESS_FROM_K = 10           # success = k >= 10
_MIN_SENSOR_VALUE = 1.0        # sensor value missing below 1
_SEQ_XOR = 7                   # arrival order = event_id XOR 7


def _first_match(cases: list, default: str) -> Column:
    """CASE WHEN c1 THEN v1 WHEN c2 THEN v2 ... ELSE default END."""
    expr = F.when(cases[0][0], F.lit(cases[0][1]))
    for cond, value in cases[1:]:
        expr = expr.when(cond, F.lit(value))
    return expr.otherwise(F.lit(default))


def signal_events(events: DataFrame) -> DataFrame:
    """Driver ``events`` -> flat signal frame (batch or stream)."""
    k = F.get_json_object("props", "$.k").try_cast("int")
    src = _first_match([(F.col("event_type") == etype, fam) for etype, fam in _SOURCE_OF_TYPE.items()], "feed")
    level = _first_match([(F.col("k") < cut, name) for cut, name in _LEVEL_CUTS], _LEVEL_TOP)
    keep_label = (F.col("k") % _MISSING_LABEL_EVERY) != 0
    ts = F.col("ts").cast("timestamp")
    return (events
            .select("event_id", "user_id", "event_type", "value", "ts", k.alias("k"))
            .select(
                "event_id",
                (F.col("event_id").bitwiseXOR(F.lit(_SEQ_XOR))).alias("arrival_seq"),
                "user_id", "k",
                F.unix_micros(ts).alias("t_us"),
                ts.alias("ts"),
                src.alias("source"),
                "event_type",
                F.col("value").alias("raw_value"))
            .select(
                "event_id", "arrival_seq", "user_id", "k", "t_us", "ts", "source", "event_type",
                F.when((F.col("source") == "sensor") & (F.col("raw_value") >= _MIN_SENSOR_VALUE),
                       F.col("raw_value")).alias("value"),
                F.when((F.col("source") == "log") & keep_label, level).alias("level"),
                F.when((F.col("source") == "feed") & keep_label, F.col("event_type")).alias("action"),
                F.when(F.col("source") == "feed", F.col("k") >= _SUCCESS_FROM_K).alias("success"))
            .drop("event_type"))


def family_filter(families: Iterable[str]) -> Column:
    """Raw-column predicate selecting event families, pushable to the Parquet scan.

    A filter on the derived ``source`` (a CASE expression) does not reach the
    scan; the same selection on ``event_type`` does.
    """
    families = set(families)
    typed = {etype for etype, fam in _SOURCE_OF_TYPE.items() if fam in families}
    conds = [F.col("event_type").isin(*sorted(typed))] if typed else []
    if "feed" in families:
        conds.append(~F.col("event_type").isin(*sorted(_SOURCE_OF_TYPE)) | F.col("event_type").isNull())
    return reduce(lambda a, b: a | b, conds) if conds else F.lit(False)


def load_signal(spark: SparkSession, sf_dir: str, families: Optional[Iterable[str]] = None) -> DataFrame:
    """Signal frame of the driver's events; ``families`` restricts it at the scan."""
    events = read_events(spark, sf_dir)
    if families is not None:
        events = events.filter(family_filter(families))
    return signal_events(events)


def ledger_from_times(events: DataFrame, received: str = "received_at", processed: str = "processed_at",
                      dropped: Optional[str] = "dropped", keep: Iterable[str] = ()) -> DataFrame:
    """Per-event processing record from measured times: received / processed time,
    latency in fractional milliseconds, drop flag.

    An event counts as dropped where ``dropped`` is true or, with ``dropped=None``,
    where it has no processed time.  ``keep`` names further columns to carry
    (default: all others).
    """
    gone = F.col(processed).isNull() if dropped is None else F.coalesce(F.col(dropped), F.lit(False))
    own = (received, processed, dropped, "received_at", "processed_at", "latency_ms", "dropped")
    keep = list(keep) or [c for c in events.columns if c not in own]
    return events.select(*keep, F.col(received).alias("received_at"), F.col(processed).alias("processed_at"),
                         latency_ms(processed, received).alias("latency_ms"), gone.alias("dropped"))


# --------------------------------------------------------------------------
# Envelope (S1 to S4)
# --------------------------------------------------------------------------

def _payload(**fields: Column) -> Column:
    """Payload struct in the superset layout; absent fields are typed nulls."""
    cols = []
    for f in PAYLOAD_SCHEMA.fields:
        c = fields.get(f.name)
        cols.append((c if c is not None else F.lit(None)).cast(f.dataType).alias(f.name))
    return F.struct(*cols)


def _envelope(signal: DataFrame, source: str, payload: Column, tags: Column) -> DataFrame:
    return signal.select(
        F.col("event_id").cast("string").alias("id"),
        F.lit(source).alias("source"),
        F.lit(DEFAULT_EVENT_TYPE).alias("event_type"),
        F.col("ts").alias("timestamp"),
        payload.alias("payload"),
        tags.alias("tags"),
        F.lit(None).cast("string").alias("correlation_id"),
        "arrival_seq")


def log_envelope(signal: DataFrame) -> DataFrame:
    """Log events; payload level/message/service/host, tags service and level."""
    rows = signal.filter(F.col("source") == "log")
    return _envelope(rows, "log", _payload(level=F.col("level")),
                     string_map(("service", F.lit(None)), ("level", F.col("level"))))


def sensor_envelope(signal: DataFrame) -> DataFrame:
    """S3: sensor events; payload sensor_id/metric/unit/value/location, tags metric and sensor_id."""
    rows = signal.filter(F.col("source") == "sensor")
    sensor_id = F.col("user_id").cast("string")
    return _envelope(rows, "sensor", _payload(sensor_id=sensor_id, value=F.col("value")),
                     string_map(("metric", F.lit(None)), ("sensor_id", sensor_id)))


def feed_envelope(signal: DataFrame) -> DataFrame:
    """Feed events; payload user_id/action/resource/success/timestamp, tags action and success."""
    rows = signal.filter(F.col("source") == "feed")
    return _envelope(rows, "feed",
                     _payload(user_id=F.col("user_id").cast("string"), action=F.col("action"),
                              success=F.col("success"), timestamp=iso_utc("ts")),
                     string_map(("action", F.col("action")), ("success", bool_text("success"))))


def with_envelope_defaults(df: DataFrame, generate_ids: bool = False) -> DataFrame:
    """Fill envelope defaults (source feed, type raw, empty tags, generated id)."""
    empty_tags = F.create_map().cast("map<string,string>")
    cols = {
        "source": F.coalesce(F.col("source"), F.lit(DEFAULT_SOURCE)),
        "event_type": F.coalesce(F.col("event_type"), F.lit(DEFAULT_EVENT_TYPE)),
        "tags": F.coalesce(F.col("tags"), empty_tags),
    }
    if generate_ids:
        # uuid() is non-deterministic: only at a sink, never inside a re-run plan
        cols["id"] = F.coalesce(F.col("id"), F.expr("uuid()"))
    if "timestamp" in df.columns:
        cols["timestamp"] = F.coalesce(F.col("timestamp"), F.current_timestamp())
    return df.withColumns(cols)


def to_envelope(signal: DataFrame) -> DataFrame:
    """All three families as envelopes in one projection (one scan, no union).

    Row for row the same as ``merge_sources`` of the three family builders.
    """
    src = F.col("source")
    is_log, is_sensor, is_feed = src == "log", src == "sensor", src == "feed"
    uid = F.col("user_id").cast("string")
    payload = _payload(level=F.when(is_log, F.col("level")),
                       value=F.when(is_sensor, F.col("value")),
                       sensor_id=F.when(is_sensor, uid),
                       user_id=F.when(is_feed, uid),
                       action=F.when(is_feed, F.col("action")),
                       success=F.when(is_feed, F.col("success")),
                       timestamp=F.when(is_feed, iso_utc("ts")))
    tags = (F.when(is_log, string_map(("service", F.lit(None)), ("level", F.col("level"))))
             .when(is_sensor, string_map(("metric", F.lit(None)), ("sensor_id", uid)))
             .otherwise(string_map(("action", F.col("action")), ("success", bool_text("success")))))
    return signal.select(
        F.col("event_id").cast("string").alias("id"), src.alias("source"),
        F.lit(DEFAULT_EVENT_TYPE).alias("event_type"), F.col("ts").alias("timestamp"),
        payload.alias("payload"), tags.alias("tags"),
        F.lit(None).cast("string").alias("correlation_id"), "arrival_seq")


_FLAT_PAYLOAD = ("value", "level", "action", "success", "message", "service", "host", "sensor_id", "metric", "unit",
                 "location", "user_id", "resource")


def flatten_envelope(env: DataFrame) -> DataFrame:
    """Envelope -> flat working columns: every payload field (the payload's own time
    as ``payload_timestamp``) and the tags."""
    return env.select(
        "id", "arrival_seq", "source",
        F.col("timestamp").alias("ts"), F.unix_micros("timestamp").alias("t_us"),
        *[F.col(f"payload.{c}").alias(c) for c in _FLAT_PAYLOAD],
        F.col("payload.timestamp").alias("payload_timestamp"), "tags")


# --------------------------------------------------------------------------
# Wire format (JSON lines) readers
# --------------------------------------------------------------------------

def payload_tags(source: Column, payload: Column) -> Column:
    """The tags a family's payload gives (absent fields give none)."""
    return (F.when(source == "log", string_map(("service", payload["service"]), ("level", payload["level"])))
             .when(source == "sensor", string_map(("metric", payload["metric"]), ("sensor_id", payload["sensor_id"])))
             .otherwise(string_map(("action", payload["action"]), ("success", bool_text(payload["success"])))))


def parse_wire(raw: DataFrame) -> DataFrame:
    """JSON wire rows -> envelope.

    The payload comes typed (the known fields), as text (``payload_json``) and as
    a VARIANT (``payload_open``), which keeps fields the schema does not know:
    ``F.try_variant_get("payload_open", "$.extra.shard", "int")``.  Rows whose
    payload is no JSON keep their text and are flagged ``malformed``; their typed
    fields are null.  Tags come from the payload; tags on the wire win.
    """
    source = F.coalesce(F.col("source"), F.lit(DEFAULT_SOURCE))
    known = raw.select(
        "id", "source", "event_type",
        F.coalesce(F.try_to_timestamp(F.col("timestamp")),
                   F.col("timestamp").try_cast("timestamp")).alias("timestamp"),
        F.col("payload").alias("payload_json"), F.try_parse_json("payload").alias("payload_open"),
        F.coalesce("tags", F.create_map().cast("map<string,string>")).alias("_given"), "correlation_id", "arrival_seq")
    malformed = F.col("payload_json").isNotNull() & F.col("payload_open").isNull()
    typed = known.withColumn("malformed", malformed).withColumn(
        "payload", F.when(~F.col("malformed"), F.from_json("payload_json", PAYLOAD_SCHEMA)))
    derived = F.map_filter(payload_tags(source, F.col("payload")), lambda k, v: ~F.map_contains_key(F.col("_given"), k))
    tagged = typed.withColumn("tags", F.map_concat(derived, "_given"))
    return with_envelope_defaults(tagged.select(
        "id", "source", "event_type", "timestamp", "payload", "payload_json", "payload_open", "malformed", "tags",
        "correlation_id", "arrival_seq"))


def parse_lines(lines: DataFrame, column: str = "line") -> DataFrame:
    """Wire events from a text column of JSON lines."""
    return parse_wire(lines.select(F.from_json(column, RAW_EVENT_SCHEMA).alias("w")).select("w.*"))


def read_wire(spark: SparkSession, path: str, stream: bool = False,
              max_files_per_trigger: Optional[int] = None) -> DataFrame:
    """Read JSON-lines events (batch or stream) with an explicit schema."""
    prepare_session(spark)
    if stream:
        reader = spark.readStream.schema(RAW_EVENT_SCHEMA)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        return parse_wire(reader.json(path))
    return parse_wire(spark.read.schema(RAW_EVENT_SCHEMA).json(path))


PARTITIONS = 1 << 16   # partitions that one arrival order can tell apart


def arrival_order(partition: Column, offset: Column) -> Column:
    """One arrival number from a partition and its offset: by offset, then by partition.

    Unique over all partitions and rising within each, so every scan, cap and
    fragment of this package takes it as ``arrival_seq``.  Offsets of 2^47 and
    more, and partitions of 2^16 and more, raise an error instead of wrapping.
    """
    part = F.when(partition.between(0, PARTITIONS - 1), partition.cast("long")).otherwise(
        F.raise_error(F.concat(F.lit("partition out of range: "), partition.cast("string"))).cast("long"))
    top = 1 << 47
    return F.when((offset >= 0) & (offset < top), offset.cast("long") * PARTITIONS + part).otherwise(
        F.raise_error(F.concat(F.lit("offset out of range: "), offset.cast("string"))).cast("long"))


def parse_broker(raw: DataFrame) -> DataFrame:
    """Wire events from rows (value, partition, offset) of a broker, in their composite arrival order."""
    wire = raw.select(F.from_json(F.col("value").cast("string"), RAW_EVENT_SCHEMA).alias("w"),
                      arrival_order(F.col("partition"), F.col("offset")).alias("_order"))
    return parse_wire(wire.select("w.*", "_order").withColumn("arrival_seq", F.col("_order")).drop("_order"))


def read_kafka(spark: SparkSession, servers: str, topic: str, stream: bool = True,
               options: Optional[dict] = None) -> DataFrame:
    """Wire events from a Kafka topic (JSON values), batch or stream.

    Needs the Spark Kafka connector on the classpath; where it is missing the
    error names it.  Other errors of the source are passed on as they are.
    """
    prepare_session(spark)
    reader = (spark.readStream if stream else spark.read).format("kafka") \
        .option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    try:
        raw = reader.load()
    except AnalysisException as exc:
        if "kafka" in str(exc).lower() and "data source" in str(exc).lower():
            raise RuntimeError("the Kafka source needs the spark-sql-kafka connector package") from exc
        raise
    return parse_broker(raw)


def to_wire(env: DataFrame) -> DataFrame:
    """Envelope -> JSON wire rows (payload as text), the inverse of ``parse_wire``."""
    return env.select("id", "source", "event_type", iso_utc("timestamp").alias("timestamp"),
                      F.to_json("payload").alias("payload"), "tags", "correlation_id", "arrival_seq")


# --------------------------------------------------------------------------
# Merge and route
# --------------------------------------------------------------------------

def merge_sources(*frames: DataFrame) -> DataFrame:
    """Bag union of per-source frames by column name."""
    frames = [f for f in frames if f is not None]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def route_source(df: DataFrame, source: str) -> DataFrame:
    """The sub-stream of one source."""
    return df.filter(F.col("source") == F.lit(source))


def route_sources(df: DataFrame, sources: Iterable[str]) -> dict[str, DataFrame]:
    return {s: route_source(df, s) for s in sources}


def write_routed(df: DataFrame, path: str, mode: str = "append") -> None:
    """S6 at rest: one folder per source so readers prune partitions."""
    df.write.mode(mode).partitionBy("source").parquet(path)


def read_routed(spark: SparkSession, path: str, source: Optional[str] = None) -> DataFrame:
    df = spark.read.parquet(path)
    return route_source(df, source) if source else df
