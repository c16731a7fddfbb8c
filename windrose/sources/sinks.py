"""Sinks and the tagged multiplex of output kinds."""

from __future__ import annotations

from functools import reduce
from typing import Optional

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrose.session import stream_checkpoint

OUTPUT_KINDS = ("event", "agg", "metrics")
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}    # the default cuts microseconds off


def multiplex(ts_cols: Optional[dict] = None, **frames: DataFrame) -> DataFrame:
    """Union of differently shaped frames as ``(type, ts, data)`` rows.

    ``data`` is the row as JSON text; ``ts`` is taken from the column named in
    ``ts_cols[kind]`` (default ``ts``), so no wall clock enters the result.
    """
    ts_cols = ts_cols or {}
    parts = []
    for kind, df in frames.items():
        ts_col = ts_cols.get(kind, "ts")
        parts.append(df.select(F.lit(kind).alias("type"),
                               F.col(ts_col).cast("timestamp").alias("ts"),
                               F.to_json(F.struct(*[F.col(c) for c in df.columns]), _JSON).alias("data")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def demultiplex(tagged: DataFrame, kinds=OUTPUT_KINDS) -> dict[str, DataFrame]:
    """One frame per known type; rows of unknown types are discarded."""
    return {k: tagged.filter(F.col("type") == k) for k in kinds}


def aggregated_events(aggs: DataFrame, deterministic_ids: bool = True) -> DataFrame:
    """S8 / A6 output form: one envelope per aggregate with ``event_type`` =
    ``aggregated`` and the payload as JSON text in the reference's layout:
    sensor ``{aggregation, metric, value}``, log ``{aggregation, levels}``, feed
    ``{aggregation, actions, success_rate}``, each with ``window: {start, end,
    count}`` in ISO text.  ``timestamp`` is the creation time, tags are empty.
    """
    from windrose.functions.scalar import iso_utc
    src = F.col("source")
    window = F.struct(iso_utc("window.start").alias("start"), iso_utc("window.end").alias("end"),
                      F.col("count").alias("count"))
    sensor = F.struct(F.col("aggregation"), F.col("metric"), F.col("value"), window.alias("window"))
    log = F.struct(F.col("aggregation"), F.col("counts").alias("levels"), window.alias("window"))
    feed = F.struct(F.col("aggregation"), F.col("counts").alias("actions"), F.col("success_rate"),
                    window.alias("window"))
    payload = (F.when(src == "sensor", F.to_json(sensor, {"ignoreNullFields": "false"}))
                .when(src == "log", F.to_json(log)).otherwise(F.to_json(feed, {"ignoreNullFields": "false"})))
    ident = (F.sha2(F.concat_ws("|", src, F.unix_micros("window.start").cast("string")), 256)
             if deterministic_ids else F.expr("uuid()"))
    return aggs.select(ident.alias("id"), src.alias("source"), F.lit("aggregated").alias("event_type"),
                       F.current_timestamp().alias("timestamp"), payload.alias("payload"),
                       F.create_map().cast("map<string,string>").alias("tags"),
                       F.lit(None).cast("string").alias("correlation_id"))


def write_aggregates(aggs: DataFrame, path: str, mode: str = "append", fmt: str = "parquet") -> None:
    """Persist aggregated records, one folder per source."""
    aggs.write.mode(mode).format(fmt).partitionBy("source").save(path)


def write_stream_aggregates(aggs: DataFrame, path: str, checkpoint: Optional[str] = None, output_mode: str = "append",
                            trigger: Optional[dict] = None):
    """S8 on a stream: file sink with its own checkpoint folder."""
    checkpoint = checkpoint or stream_checkpoint(aggs.sparkSession, path)
    w = (aggs.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint).outputMode(output_mode))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
