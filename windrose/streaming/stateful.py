"""Order-dependent operators on streams: ST2, ST3 / ST5 (exact), ST6, the admission
cap S7 and the latency ring ST8.

* ``anchored_windows_stream`` / ``throttle_stream``: ``applyInPandasWithState``
  keyed by the user's key; the state is one open window (start, opener seq,
  running max).  Rows of a micro-batch are taken in arrival sequence;
  across micro-batches arrival order rules, as in the reference.  Work per key
  and batch is bounded by the trigger's limits (``maxFilesPerTrigger`` /
  ``maxOffsetsPerTrigger``).
* With a ``delay`` states end: a window that the watermark has passed, or an
  interval that is over, is given up, since any event on time would start anew.
* ``latency_ring_stream``: the last samples of every source and their statistics.
* ``start_arrival_fragments``: the exact fragmenting mode.  Each micro-batch
  runs the distributed batch operator (two-level scan) and continues the
  numbering from a one-row carry written next to the output, so a replayed
  batch finds the same carry and overwrites the same folder.

Pandas turns a long column with nulls into doubles, so passed-through long
columns travel as text and come back as longs.
"""

from __future__ import annotations

import heapq
from typing import Iterator, Optional, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from windrose.functions.scalar import Duration, duration_us, floor_window
from windrose.operators.observe import LATENCY_SAMPLES, PERCENTILES
from windrose.operators.sequence import _NO_SEQ, arrival_fragments, fold_segment
from windrose.session import stream_checkpoint

_STATE = T.StructType([T.StructField("start_us", T.LongType()), T.StructField("start_seq", T.LongType()),
                       T.StructField("pm_us", T.LongType())])


def _in_order(batches: Iterator[pd.DataFrame], by: str) -> tuple[list[pd.DataFrame], np.ndarray]:
    """The Arrow batches of a key as they come, and their rows' positions in order.
    Only the order column is put together; the batches stay apart."""
    frames = [pdf for pdf in batches if len(pdf)]
    keys = np.concatenate([pdf[by].to_numpy(dtype=np.int64) for pdf in frames]) if frames else np.zeros(0, np.int64)
    return frames, np.argsort(keys, kind="stable")


def _column(frames: list[pd.DataFrame], name: str, order: np.ndarray) -> np.ndarray:
    return np.concatenate([pdf[name].to_numpy(dtype=np.int64) for pdf in frames])[order]


def _back(frames: list[pd.DataFrame], order: np.ndarray, **ordered: np.ndarray) -> Iterator[pd.DataFrame]:
    """Each batch with its rows' share of the ordered result columns."""
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    at = 0
    for pdf in frames:
        mine = place[at:at + len(pdf)]
        at += len(pdf)
        yield pdf.assign(**{name: values[mine] for name, values in ordered.items()})


def _prepared(sig: DataFrame, cols: Sequence[str], ts: str, seq: str, delay: Optional[Duration], **more) -> DataFrame:
    src = sig if delay is None else sig.withWatermark(ts, f"{duration_us(delay, allow_zero=True)} microseconds")
    kept = [F.col(c).cast("string").alias(c) if isinstance(sig.schema[c].dataType, T.LongType) else F.col(c) for c in cols]
    # an event without a time comes before all others; so does one without a number
    return src.select(*kept, F.coalesce(F.unix_micros(F.col(ts)), F.lit(-(1 << 62))).alias("_t"),
                      F.coalesce(F.col(seq).cast("long"), F.lit(_NO_SEQ)).alias("_seq"),
                      *([F.col(ts).alias("_event_time")] if delay is not None else []),
                      *[c.alias(n) for n, c in more.items()])


def _restored(out: DataFrame, sig: DataFrame, cols: Sequence[str]) -> DataFrame:
    longs = {c: F.col(c).cast("long") for c in cols if isinstance(sig.schema[c].dataType, T.LongType)}
    return out.withColumns(longs) if longs else out


def _timer(delay: Optional[Duration]) -> str:
    return GroupStateTimeout.NoTimeout if delay is None else GroupStateTimeout.EventTimeTimeout


def _ends_at(state: GroupState, us: int) -> None:
    """Let the state end when the watermark passes an instant."""
    state.setTimeoutTimestamp(max(us // 1000 + 1, state.getCurrentWatermarkMs() + 1))


def _anchored_fn(size_us: int, only_openers: bool, timed: bool):
    def fn(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        frames, order = _in_order(batches, "_seq")
        if not frames:
            return
        t, sq = _column(frames, "_t", order), _column(frames, "_seq", order)
        start, start_seq, pm = state.get if state.exists else (None, None, None)
        opener, opens, _, pm = fold_segment(t, size_us, start, pm)
        carried = opener < 0
        ws = np.where(carried, start if start is not None else 0, t[np.maximum(opener, 0)])
        wq = np.where(carried, start_seq if start_seq is not None else 0, sq[np.maximum(opener, 0)])
        if opens.any():
            last = int(np.flatnonzero(opens)[-1])
            start, start_seq = int(t[last]), int(sq[last])
        state.update((int(start), int(start_seq), int(pm)))
        if timed:
            _ends_at(state, int(start) + size_us)
        for out in _back(frames, order, window_start_us=ws, window_seq=wq, opens_window=opens):
            if only_openers:
                out = out[out["opens_window"]]
            yield out.drop(columns=["_t", "_seq"] + (["_event_time"] if timed else []))
    return fn


def anchored_windows_stream(sig: DataFrame, size: Duration, keys: Sequence[str],
                            ts: str = "ts", seq: str = "arrival_seq", columns: Sequence[str] = (),
                            only_openers: bool = False, delay: Optional[Duration] = None) -> DataFrame:
    """ST2 on a stream: per event, the anchored window it belongs to (append mode).

    With a ``delay`` the state of a key ends once the watermark has passed its
    window; an event later than that opens a window of its own.
    """
    keys = list(keys)
    cols = list(dict.fromkeys([*keys, seq, *columns]))
    src = _prepared(sig, cols, ts, seq, delay)
    out_schema = T.StructType([src.schema[c] for c in cols]
                              + [T.StructField("window_start_us", T.LongType()), T.StructField("window_seq", T.LongType()),
                                 T.StructField("opens_window", T.BooleanType())])
    out = src.groupBy(*keys).applyInPandasWithState(
        _anchored_fn(duration_us(size), only_openers, delay is not None), out_schema, _STATE, "append", _timer(delay))
    return _restored(out, sig, cols).withColumn("window_seq", F.nullif("window_seq", F.lit(_NO_SEQ)))


def throttle_stream(sig: DataFrame, min_gap: Duration = "100 milliseconds", key: str = "source",
                    ts: str = "ts", seq: str = "arrival_seq", columns: Sequence[str] = (),
                    delay: Optional[Duration] = None) -> DataFrame:
    """ST6 on a stream: emit an event only if ``min_gap`` passed since the last emitted one."""
    return anchored_windows_stream(sig, min_gap, [key], ts, seq, columns, only_openers=True, delay=delay) \
        .drop("window_start_us", "window_seq", "opens_window")


_FRAG_STATE = T.StructType([T.StructField("ws_us", T.LongType()), T.StructField("fragment_id", T.LongType())])


def _fragments_fn(size_us: int):
    def fn(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        frames, order = _in_order(batches, "_seq")
        if not frames:
            return
        t = _column(frames, "_t", order)
        ws = t - np.mod(t, size_us)
        prev_ws, fid = state.get if state.exists else (None, 0)
        prev = np.concatenate([[ws[0] if prev_ws is None else prev_ws], ws[:-1]])
        change = ws != prev
        if prev_ws is None:
            change[0] = True
        ids = fid + np.cumsum(change)
        state.update((int(ws[-1]), int(ids[-1])))
        for out in _back(frames, order, window_start_us=ws, fragment_id=ids):
            yield out.drop(columns=["_t", "_seq"])
    return fn


def arrival_fragments_stream(sig: DataFrame, size: Duration, keys: Sequence[str], ts: str = "ts",
                             seq: str = "arrival_seq", columns: Sequence[str] = ()) -> DataFrame:
    """ST3 / ST5 per key on a stream: a new fragment whenever an event's epoch
    window differs from the previous event's of the same key (arrival order).
    State per key: the last window and fragment id; it stays, since the numbering
    goes on.  The global (unkeyed) form is ``start_arrival_fragments``."""
    keys = list(keys)
    cols = list(dict.fromkeys([*keys, seq, *columns]))
    src = _prepared(sig, cols, ts, seq, None)
    out_schema = T.StructType([src.schema[c] for c in cols]
                              + [T.StructField("window_start_us", T.LongType()),
                                 T.StructField("fragment_id", T.LongType())])
    out = src.groupBy(*keys).applyInPandasWithState(
        _fragments_fn(duration_us(size)), out_schema, _FRAG_STATE, "append", GroupStateTimeout.NoTimeout)
    return _restored(out, sig, cols)


_CAP_STATE = T.StructType([T.StructField("merged", T.LongType()),
                           T.StructField("per_source", T.MapType(T.StringType(), T.LongType()))])


def _cap_fn(merged_cap: int, source_cap: Optional[int], source: str, interval_us: int, timed: bool):
    def fn(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        frames, order = _in_order(batches, "_seq")
        if not frames:
            return
        end = int(frames[0]["_bucket_us"].iat[0]) + interval_us
        late = timed and not state.exists and end // 1000 < state.getCurrentWatermarkMs()
        merged, per_source = state.get if state.exists else (0, {})
        per_source = dict(per_source or {})
        n = len(order)
        accepted = np.zeros(n, bool) if late else merged + np.arange(1, n + 1) <= merged_cap
        in_source = np.ones(n, bool)
        if source_cap is not None:
            src = np.concatenate([pdf[source].fillna("").to_numpy() for pdf in frames])[order]
            rank = pd.Series(1, index=range(n)).groupby(src).cumsum().to_numpy() + \
                np.array([per_source.get(x, 0) for x in src], dtype=np.int64)
            in_source = rank <= source_cap
            for name, m in pd.Series(src).value_counts().items():
                per_source[name] = per_source.get(name, 0) + int(m)
        if not late:
            state.update((int(merged + n), per_source))
            if timed:
                _ends_at(state, end)
        for out in _back(frames, order, accepted=accepted, dropped=~accepted | ~in_source):
            yield out.drop(columns=["_t", "_seq", "_bucket_us"] + (["_event_time"] if timed else []))
    return fn


def admission_cap_stream(sig: DataFrame, interval: Duration, merged_cap: int, source_cap: Optional[int] = None,
                         ts: str = "ts", seq: str = "arrival_seq", source: str = "source",
                         columns: Sequence[str] = (), delay: Optional[Duration] = None) -> DataFrame:
    """S7 on a stream: the first ``merged_cap`` events of each interval (and
    ``source_cap`` per source) are kept, the rest flagged, across micro-batches.
    State per interval: the events seen so far, overall and per source.  With a
    ``delay`` it ends with the watermark, and later events count as dropped."""
    cols = list(dict.fromkeys([seq, source, *columns]))
    start = floor_window(ts, interval)
    src = _prepared(sig, cols, ts, seq, delay, bucket_start=start,
                    _bucket_us=F.coalesce(F.unix_micros(start), F.lit(-(1 << 62))))
    out_schema = T.StructType([src.schema["bucket_start"], *[src.schema[c] for c in cols],
                               T.StructField("accepted", T.BooleanType()), T.StructField("dropped", T.BooleanType())])
    out = src.groupBy("bucket_start").applyInPandasWithState(
        _cap_fn(merged_cap, source_cap, source, duration_us(interval), delay is not None), out_schema, _CAP_STATE, "append",
        _timer(delay))
    return _restored(out, sig, cols)


_RING_STATE = T.StructType([T.StructField("at", T.ArrayType(T.LongType())), T.StructField("seq", T.ArrayType(T.LongType())),
                            T.StructField("ms", T.ArrayType(T.DoubleType())), T.StructField("seen", T.LongType())])


def _ring_fn(keep: int):
    def fn(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        at, seq, ms, seen = state.get if state.exists else ([], [], [], 0)
        ring = list(zip(at, seq, ms))
        for pdf in batches:       # the ring never holds more than ``keep`` samples and one Arrow batch
            seen += len(pdf)
            rows = zip(pdf["_at"].tolist(), pdf["_seq"].tolist(), pdf["latency_ms"].tolist())
            ring = heapq.nlargest(keep, [*ring, *rows], key=lambda r: r[:2])
        ring.sort()
        state.update(([r[0] for r in ring], [r[1] for r in ring], [r[2] for r in ring], int(seen)))
        values = sorted(r[2] for r in ring)
        ranks = {f"latency_{name}": [values[int(q * (len(values) - 1))]] for name, q in PERCENTILES.items()}
        yield pd.DataFrame({"source": [key[0]], "processed_total": [seen], "samples": [len(values)],
                            "latency_avg": [float(np.mean(values))], **ranks})
    return fn


def latency_ring_stream(ledger_stream: DataFrame, max_samples: int = LATENCY_SAMPLES) -> DataFrame:
    """ST8 / A12 on a stream: per source, at every trigger that brings new events, the
    processed total and avg / p50 / p95 (floor rank) of its last ``max_samples``
    latencies in processing order (update mode: the newest row of a source counts)."""
    rows = ledger_stream.filter(~F.col("dropped") & F.col("latency_ms").isNotNull()).select(
        "source", F.coalesce(F.unix_micros("processed_at"), F.lit(-(1 << 62))).alias("_at"),
        F.coalesce(F.col("arrival_seq").cast("long"), F.lit(_NO_SEQ)).alias("_seq"), "latency_ms")
    doubles = [T.StructField(c, T.DoubleType()) for c in ("latency_avg", "latency_p50", "latency_p95")]
    return rows.groupBy("source").applyInPandasWithState(
        _ring_fn(max_samples), T.StructType([T.StructField("source", T.StringType()), T.StructField("processed_total", T.LongType()),
                                             T.StructField("samples", T.LongType()), *doubles]),
        _RING_STATE, "update", GroupStateTimeout.NoTimeout)


def start_arrival_fragments(sig: DataFrame, size: Duration, path: str, checkpoint: Optional[str] = None,
                            ts: str = "ts", seq: str = "arrival_seq", trigger: Optional[dict] = None,
                            bucket_rows="auto"):
    """ST3 / ST5 exact mode: per-event fragment ids across micro-batches.

    The carry (window start of the last event and its fragment id) is a
    one-row table per batch id under ``<path>/_carry``; reading it back is the
    only thing the driver collects.
    """
    checkpoint = checkpoint or stream_checkpoint(sig.sparkSession, path)
    out_root = path.rstrip("/")

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        prev = None
        if batch_id > 0:
            try:
                prev = spark.read.parquet(f"{out_root}/_carry/batch_id={batch_id - 1}").first()
            except AnalysisException as missing:
                # only an absent carry (empty first batches) may restart the numbering
                if missing.getCondition() != "PATH_NOT_FOUND":
                    raise
        frags = arrival_fragments(batch, size, ts=ts, seq=seq, bucket_rows=bucket_rows)
        if prev is not None and prev["last_ws_us"] is not None:
            first_ws = frags.agg(F.min_by(F.unix_micros("window_start"), F.col(seq))).scalar()
            shift = (F.lit(prev["last_fragment"])
                     - F.when(first_ws == F.lit(prev["last_ws_us"]), 1).otherwise(0))
            frags = frags.withColumn("fragment_id", F.col("fragment_id") + shift)
        frags = frags.withColumn("batch_id", F.lit(batch_id).cast("long"))
        frags.write.mode("overwrite").parquet(f"{out_root}/batch_id={batch_id}")
        written = spark.read.parquet(f"{out_root}/batch_id={batch_id}")
        last = written.agg(F.max_by(F.unix_micros("window_start"), F.col(seq)).alias("last_ws_us"),
                           F.max_by(F.col("fragment_id"), F.col(seq)).alias("last_fragment"))
        if prev is not None:
            fallback = F.lit(prev["last_ws_us"]).cast("long"), F.lit(prev["last_fragment"]).cast("long")
            last = last.select(F.coalesce("last_ws_us", fallback[0]).alias("last_ws_us"),
                               F.coalesce("last_fragment", fallback[1]).alias("last_fragment"))
        last.write.mode("overwrite").parquet(f"{out_root}/_carry/batch_id={batch_id}")

    w = sig.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def read_arrival_fragments(spark, path: str) -> DataFrame:
    """The per-event fragment labels written by ``start_arrival_fragments``."""
    return spark.read.option("basePath", path).parquet(f"{path.rstrip('/')}/batch_id=*")
