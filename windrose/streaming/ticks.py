"""ST7: the periodic metrics publisher as a stream, and the rate of a stream.

Every micro-batch of the ledger stream is reduced to partials that add up
across batches: counts per tick (``kpi_tick_partials``), the newest latency
samples of each tick, and counts and time bounds per window.  They lie under
``<path>/{ticks,samples,windows}/batch_id=N`` with one commit mark per batch.
Aggregated records, read as a stream from the output of the aggregating query,
are marked in their own partials.  The published series is a batch query over
the sums, and equals the batch series of the same ledger.  Use
``trigger={"processingTime": "2 seconds"}`` for the live cadence.
"""

from __future__ import annotations

from typing import Callable, Optional, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from windrose.functions.scalar import Duration, duration_us, floor_window
from windrose.operators import observe as O
from windrose.operators.observe import RATE_HORIZON, SNAPSHOT_PERIOD
from windrose.session import stream_checkpoint
from windrose.sources.schema import SOURCES
from windrose.streaming.commits import committed, with_commits

_COUNTS = ("ingest_n", "process_n", "agg_n", "new_ingested", "new_dropped", "new_processed", "new_aggregated")


def window_partials(ledger: DataFrame, size: Duration) -> DataFrame:
    """Counts per source and time bounds of the processed events of each window; they add up."""
    rows = O.processed_rows(ledger)
    return rows.groupBy(floor_window("received_at", size).alias("window_start")).agg(
        *[F.count_if(F.col("source") == s).alias(f"n_{s}") for s in SOURCES], F.count(F.lit(1)).alias("count_total"),
        F.min("received_at").alias("first_ts"), F.max("received_at").alias("last_ts"))


def start_metrics_publisher(ledger_stream: DataFrame, path: str, checkpoint: Optional[str] = None,
                            trigger: Optional[dict] = None, period=SNAPSHOT_PERIOD, horizon=RATE_HORIZON,
                            window: Optional[Duration] = None,
                            after_batch: Optional[Callable[[DataFrame, int], None]] = None):
    """Publish the partials of a ledger stream; with a ``window`` size those of its windows too."""
    checkpoint = checkpoint or stream_checkpoint(ledger_stream.sparkSession, path)
    root = path.rstrip("/")

    def publish(batch: DataFrame, batch_id: int) -> None:
        # three reductions of one batch
        batch.persist()
        try:
            parts = {"ticks": O.kpi_tick_partials(batch, None, period, horizon),
                     "samples": O.newest_per_tick(O.processed_rows(batch), period)}
            if window is not None:
                parts["windows"] = window_partials(batch, window)
            for name, part in parts.items():
                part.write.mode("overwrite").parquet(f"{root}/{name}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    w = (ledger_stream.writeStream.foreachBatch(with_commits(root, publish, after_batch))
         .option("checkpointLocation", checkpoint))
    return w.trigger(**(trigger or {"availableNow": True})).start()


def start_aggregate_publisher(aggregates: DataFrame, path: str, checkpoint: Optional[str] = None, trigger: Optional[dict] = None,
                              period=SNAPSHOT_PERIOD, horizon=RATE_HORIZON,
                              after_batch: Optional[Callable[[DataFrame, int], None]] = None):
    """Publish the marks of aggregated records, for example
    ``spark.readStream.schema(s).parquet(<output of start_window_aggregates>)``."""
    root = f"{path.rstrip('/')}/aggregates"
    checkpoint = checkpoint or stream_checkpoint(aggregates.sparkSession, root)

    def publish(batch: DataFrame, batch_id: int) -> None:
        O.aggregate_tick_partials(batch, period, horizon).write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")

    w = aggregates.writeStream.foreachBatch(with_commits(root, publish, after_batch)).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def read_kpi_series(spark: SparkSession, path: str, period=SNAPSHOT_PERIOD, horizon=RATE_HORIZON) -> DataFrame:
    parts = [p.select("tick_us", *_COUNTS) for p in (committed(spark, path, "ticks"),
                                                     committed(spark, f"{path.rstrip('/')}/aggregates")) if p is not None]
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return O.kpi_from_partials(both.groupBy("tick_us").agg(*[F.sum(c).alias(c) for c in _COUNTS]), period, horizon)


def read_kpi_history(spark: SparkSession, path: str, period=SNAPSHOT_PERIOD, horizon=RATE_HORIZON) -> DataFrame:
    """ST9 of what has been published: equals ``kpi_history`` of the same ledger."""
    samples = O.newest_per_tick(committed(spark, path, "samples"), period)
    return O.history_with_latency(read_kpi_series(spark, path, period, horizon), samples)


def read_window_records(spark: SparkSession, path: str) -> DataFrame:
    """A11 of what has been published: one record per window over all batches."""
    parts = committed(spark, path, "windows")
    names = [f"n_{s}" for s in SOURCES]
    g = parts.groupBy("window_start").agg(*[F.sum(c).cast("long").alias(c) for c in (*names, "count_total")],
                                          F.min("first_ts").alias("_lo"), F.max("last_ts").alias("_hi"))
    emitted = sum((F.col(c) > 0).cast("int") for c in names)
    return (g.withColumn("span_ms", (F.unix_micros("_hi") - F.unix_micros("_lo")) / 1000.0)
            .withColumn("aggregates_emitted", emitted).drop("_lo", "_hi"))


def rate_ticks_stream(events: DataFrame, delay: Duration, ts: str = "ts", period: Duration = SNAPSHOT_PERIOD,
                      horizon: Duration = RATE_HORIZON, keys: Sequence[str] = ()) -> DataFrame:
    """W2 on a stream: the rate at each tick T over ``[T - horizon, T]``, closed ticks in append mode.

    A sliding window is open at its end; one microsecond more closes it, so an
    event exactly on a tick counts there and at the tick one horizon later, as in
    ``rate_ticks``.  Events later than ``delay`` may be dropped.
    """
    p, h = duration_us(period), duration_us(horizon)
    us = lambda n: f"{n} microseconds"
    w = F.window(ts, us(h + 1), us(p), us(-h % p))
    counted = events.withWatermark(ts, us(duration_us(delay, allow_zero=True))).groupBy(w.alias("w"), *keys).agg(
        F.count(F.lit(1)).alias("n"))
    return counted.select((F.unix_micros("w.end") - 1).alias("tick_us"), *keys, "n", (F.col("n") / F.lit(h / 1_000_000)).alias("eps"))


class ProgressCollector(StreamingQueryListener):
    """ST7 live side: keep the last ``keep`` progress reports of every query
    (rows, rates, batch duration, observed metrics) on the driver; bounded,
    like the reference's history of 200 snapshots."""

    def __init__(self, keep: int = 200):
        self.keep = keep
        self.reports: list[dict] = []

    def onQueryStarted(self, event):  # noqa: N802 - Spark's callback names
        pass

    def onQueryProgress(self, event):  # noqa: N802
        p = event.progress
        self.reports.append({
            "id": str(p.id), "batch_id": p.batchId, "rows": p.numInputRows,
            "input_rps": p.inputRowsPerSecond, "processed_rps": p.processedRowsPerSecond,
            "duration_ms": dict(p.durationMs or {}),
            "observed": {k: v.asDict() for k, v in (p.observedMetrics or {}).items()},
        })
        del self.reports[:-self.keep]

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        pass
