"""Live (streaming) window aggregation: ST1, ST4, ST5, ST8, S8, X5.

* ``window_aggregates_stream``: epoch-aligned tumbling aggregation with a
  watermark; the two-level recipe R1 runs as chained aggregates, which Spark
  accepts in append mode.  Closed windows are emitted once.
* ``start_live_partials`` / ``read_live_view``: the live view that also shows
  the open window (the reference's flush).  Only the first level is streamed,
  in update mode; every micro-batch writes its updated partials to
  ``<path>/batch_id=N`` and a commit mark, versions are merged into
  generations now and then, and the view keeps the latest version of each
  (window, source, label) and applies the second level as a batch query.
* ``observe_processing``: per-event processing metrics on the unfiltered
  stream through ``DataFrame.observe`` (reported in the query progress).
"""

from __future__ import annotations

import json
from typing import Callable, Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrose.functions.scalar import Duration, strict_true
from windrose.operators.aggregate import combine_partials, label_of
from windrose.sources.ingest import signal_events, stream_events
from windrose.session import stream_checkpoint
from windrose.streaming.commits import children, committed_ids, delete, read_text, with_commits, write_text


def signal_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: Optional[int] = None) -> DataFrame:
    """The driver's events as a streaming signal frame."""
    return signal_events(stream_events(spark, sf_dir, max_files_per_trigger))


def stream_partials(sig: DataFrame, size: Duration, delay: Optional[Duration] = None,
                    ts: str = "ts") -> DataFrame:
    """First level of R1 on a stream: (window, source, label) partial sums."""
    src = sig.withWatermark(ts, _interval(delay)) if delay is not None else sig
    return (src.groupBy(F.window(ts, _interval(size)).alias("w"), F.col("source"), label_of().alias("label"))
               .agg(F.sum("value").alias("value_sum"), F.count("value").alias("value_n"),
                    F.count_if(strict_true("success")).alias("ok_n"), F.count(F.lit(1)).alias("n")))


def window_aggregates_stream(sig: DataFrame, size: Duration, delay: Duration,
                             ts: str = "ts") -> DataFrame:
    """ST1 / ST5: closed windows, one aggregated record per (window, source).

    Events later than ``delay`` behind the newest one may be dropped by Spark
    (reported as ``numRowsDroppedByWatermark``), so the caller must choose it;
    ``arrival_fragments`` is the exact mode, which drops nothing.
    """
    return combine_partials(stream_partials(sig, size, delay, ts), size, window_struct="w")


def start_window_aggregates(sig: DataFrame, size: Duration, path: str, checkpoint: Optional[str] = None,
                            *, delay: Duration, trigger: Optional[dict] = None,
                            fmt: str = "parquet", after_batch: Optional[Callable[[DataFrame, int], None]] = None):
    """Stream closed-window aggregates to files (append mode).

    With an ``after_batch`` hook (X5) the batches go to ``<path>/batch_id=N`` with
    one commit mark each (``commits.committed`` reads them), and the hook is
    called once for each."""
    checkpoint = checkpoint or stream_checkpoint(sig.sparkSession, path)
    out = window_aggregates_stream(sig, size, delay)
    if after_batch is not None:
        def write(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/batch_id={batch_id}")

        w = (out.writeStream.foreachBatch(with_commits(path, write, after_batch))
             .option("checkpointLocation", checkpoint).outputMode("append"))
    else:
        w = (out.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint)
             .outputMode("append"))
    return w.trigger(**(trigger or {"availableNow": True})).start()


_PARTIAL = ("value_sum", "value_n", "ok_n", "n")
_KEY = ("window_start", "source", "label")


def start_live_partials(sig: DataFrame, size: Duration, path: str, checkpoint: Optional[str] = None,
                        trigger: Optional[dict] = None,
                        after_batch: Optional[Callable[[DataFrame, int], None]] = None,
                        delay: Optional[Duration] = None, compact_every: int = 50):
    """ST4 live view: stream first-level partials in update mode to versioned files.

    Every ``compact_every`` batches the versions are merged into one generation, so
    a reader opens a bounded number of files however long the stream runs.  With
    a ``delay`` the state of windows that old is given up, and events later than
    that may be dropped.
    """
    checkpoint = checkpoint or stream_checkpoint(sig.sparkSession, path)
    partials = stream_partials(sig, size, delay).select(F.col("w.start").alias("window_start"), "source", "label", *_PARTIAL)
    root = path.rstrip("/")

    def upsert(batch: DataFrame, batch_id: int) -> None:
        # one micro-batch updates few (window, source, label): few files
        (batch.withColumn("version", F.lit(batch_id).cast("long")).coalesce(4)
              .write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}"))

    def after(batch: DataFrame, batch_id: int) -> None:
        if compact_every and (batch_id + 1) % compact_every == 0:
            compact_live_partials(batch.sparkSession, root)
        if after_batch is not None:
            after_batch(batch, batch_id)

    w = (partials.writeStream.outputMode("update").foreachBatch(with_commits(root, upsert, after))
         .option("checkpointLocation", checkpoint))
    return w.trigger(**(trigger or {"availableNow": True})).start()


def _live_state(spark: SparkSession, root: str) -> tuple[dict, list[str]]:
    """The current generation's record and the folders that make up the view."""
    state = json.loads(read_text(spark, f"{root}/_generation") or '{"generation": 0, "upto": -1}')
    folders = [f"{root}/batch_id={i}" for i in committed_ids(spark, root) if i > state["upto"]]
    if state["generation"]:
        folders.insert(0, f"{root}/generation={state['generation']}")
    return state, folders


def _newest(spark: SparkSession, folders: list[str]) -> DataFrame:
    """The newest version of every partial."""
    parts = spark.read.parquet(*folders)
    fields = F.struct(*_PARTIAL, "version")
    return parts.groupBy(*_KEY).agg(F.max_by(fields, F.col("version")).alias("p")).select(*_KEY, "p.*")


def compact_live_partials(spark: SparkSession, path: str, files: int = 8) -> int:
    """Merge the committed versions into a new generation and switch to it by one small
    file that is replaced whole; returns the generation's number.

    What the new generation covers is deleted at the next compaction, so a reader
    that has just looked up the old one can finish.
    """
    root = path.rstrip("/")
    state, folders = _live_state(spark, root)
    done = [i for i in committed_ids(spark, root) if i > state["upto"]]
    if not done:
        return state["generation"]
    new = state["generation"] + 1
    _newest(spark, folders).coalesce(files).write.mode("overwrite").parquet(f"{root}/generation={new}")
    write_text(spark, f"{root}/_generation", json.dumps({"generation": new, "upto": done[-1], "before": state["upto"]}))
    if state["generation"]:
        for name in children(spark, root):
            kind, _, number = name.partition("=")
            if kind == "batch_id" and int(number) <= state["upto"] or kind == "generation" and int(number) < state["generation"]:
                delete(spark, f"{root}/{name}")
    return new


def read_live_view(spark: SparkSession, path: str, size: Duration) -> DataFrame:
    """Second level over the newest version of every partial: all windows, open ones included."""
    _, folders = _live_state(spark, path.rstrip("/"))
    return combine_partials(_newest(spark, folders).select(*_KEY, *_PARTIAL), size)


def flush_sentinel(events: DataFrame, size: Duration, delay: Duration = "0 seconds",
                   ts: str = "ts") -> DataFrame:
    """ST4 for bounded runs: a one-row closing event after the last event.

    Read by the stream as its last file, it moves the watermark past every real
    window, so append mode emits all of them; its own window stays open and
    never reaches the sink.  It must pass through the aggregate: a filter on it
    would be pushed below the watermark.
    """
    from windrose.functions.scalar import duration_us
    gap = duration_us(size) * 2 + duration_us(delay, allow_zero=True) + 1
    return (events.agg(F.max(ts).alias(ts))
                  .select(*[(F.col(ts) + F.make_dt_interval(secs=F.lit(gap / 1e6))).alias(ts) if c == ts
                            else (F.lit(-1) if c == "event_id" else F.lit(None)).cast(events.schema[c].dataType)
                            .alias(c) for c in events.columns]))


def write_flush_sentinel(spark: SparkSession, events_dir: str, sentinel_dir: str, size: Duration,
                         delay: Duration = "0 seconds", glob: str = "*.parquet") -> str:
    """Write the closing sentinel to a folder of its own beside the events' folder
    and return the path pattern that a stream reads both by.  The table of
    events itself is left as it is."""
    parent, name = events_dir.rstrip("/").rsplit("/", 1)
    other, sentinel = sentinel_dir.rstrip("/").rsplit("/", 1)
    if parent != other or name == sentinel:
        raise ValueError("the sentinel's folder must stand beside the folder of the events")
    events = spark.read.parquet(f"{events_dir.rstrip('/')}/{glob}")
    flush_sentinel(events, size, delay).coalesce(1).write.mode("overwrite").parquet(sentinel_dir)
    return f"{parent}/{{{name},{sentinel}}}"


def with_after_batch(fn: Callable[[DataFrame, int], None],
                     hook: Optional[Callable[[DataFrame, int], None]] = None) -> Callable[[DataFrame, int], None]:
    """Run ``hook`` after each micro-batch; its exceptions are swallowed
    (as the reference does for its after-batch hook), the batch's are not.
    ``commits.with_commits`` does so once per batch id."""
    def run(batch: DataFrame, batch_id: int) -> None:
        fn(batch, batch_id)
        if hook is not None:
            try:
                hook(batch, batch_id)
            except Exception:  # noqa: BLE001 - hook errors must not stop the stream
                pass
    return run


def observe_processing(ledger_stream: DataFrame, name: str = "processing") -> DataFrame:
    """ST8: processed count and latency of the *unfiltered* stream, reported in
    ``StreamingQueryProgress.observedMetrics`` without a second query."""
    return ledger_stream.observe(name, F.count(F.lit(1)).alias("events"),
                                 F.count_if(~F.col("dropped")).alias("processed"),
                                 F.avg("latency_ms").alias("latency_avg"))


def _interval(d: Duration) -> str:
    if isinstance(d, str):
        return d
    from windrose.functions.scalar import duration_us
    return f"{duration_us(d)} microseconds"
