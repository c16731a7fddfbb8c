"""Streaming = batch: availableNow runs over a copy of the driver's events."""

import os
import shutil
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from windrose.operators import aggregate as A
from windrose.operators import observe as O
from windrose.operators import sequence as Q
from windrose.plans import fixtures as X
from windrose.sources import ingest as I
from windrose.sources.schema import DRIVER_EVENTS_SCHEMA
from windrose.streaming import commits as C
from windrose.streaming import live as L
from windrose.streaming import stateful as ST
from windrose.streaming import ticks as TK

HOUR = "1 hour"


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="windrose-stream-")


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def _with_sentinel(spark, scratch):
    """Copy the events and write a closing sentinel beside them (ST4 flush)."""
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    shutil.copy(f"{SF_SMALL}/events.parquet", os.path.join(src, "events.parquet"))
    both = L.write_flush_sentinel(spark, src, os.path.join(scratch, "flush"), HOUR)
    assert os.listdir(src) == ["events.parquet"]
    return both


def test_stream_window_aggregates_equal_batch(spark, scratch):
    src = _with_sentinel(spark, scratch)
    stream = I.signal_events(spark.readStream.schema(DRIVER_EVENTS_SCHEMA).option("maxFilesPerTrigger", 1)
                             .parquet(src))
    # the sentinel passes through the aggregate (a filter would be pushed below
    # the watermark and cancel its effect); its own window stays open
    out = os.path.join(scratch, "out")
    q = L.start_window_aggregates(stream, HOUR, out, os.path.join(scratch, "ck"), delay="0 seconds")
    q.awaitTermination(300)
    got = spark.read.parquet(out)
    batch = A.window_source_aggregates(I.load_signal(spark, SF_SMALL), HOUR)
    cols = ["source", "count", "aggregation"]
    g = got.select(F.col("window.start").alias("ws"), *cols, F.round("value", 6).alias("v"),
                   F.round("success_rate", 6).alias("r"))
    b = batch.select(F.col("window.start").alias("ws"), *cols, F.round("value", 6).alias("v"),
                     F.round("success_rate", 6).alias("r"))
    assert _rows(g, g.columns) == _rows(b, b.columns)


def test_live_view_includes_open_window(spark, scratch):
    stream = L.signal_stream(spark, SF_SMALL)
    path = os.path.join(scratch, "partials")
    q = L.start_live_partials(stream, HOUR, path, os.path.join(scratch, "ck"))
    q.awaitTermination(300)
    view = L.read_live_view(spark, path, HOUR)
    batch = A.window_source_aggregates(I.load_signal(spark, SF_SMALL), HOUR)
    assert _rows(view, ["source", "count"]) == _rows(batch, ["source", "count"])


def test_stream_anchored_and_throttle_equal_batch(spark, scratch):
    sig = I.load_signal(spark, SF_SMALL)
    stream = L.signal_stream(spark, SF_SMALL)
    q = (ST.anchored_windows_stream(stream, HOUR, keys=["user_id"]).writeStream.format("memory")
         .queryName("anchored_stream").outputMode("append").option("checkpointLocation", os.path.join(scratch, "a"))
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = spark.table("anchored_stream")
    batch = Q.anchored_windows(sig, HOUR, keys=["user_id"])
    cols = ["arrival_seq", "window_seq", "window_start_us"]
    assert _rows(got, cols) == _rows(batch, cols)
    q2 = (ST.throttle_stream(stream, "10 minutes").writeStream.format("memory").queryName("throttle_stream")
          .outputMode("append").option("checkpointLocation", os.path.join(scratch, "t"))
          .trigger(availableNow=True).start())
    q2.awaitTermination(300)
    assert _rows(spark.table("throttle_stream"), ["arrival_seq"]) == \
        _rows(Q.throttle(sig, "10 minutes"), ["arrival_seq"])


def test_stream_fragments_equal_batch_across_micro_batches(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    sig = I.load_signal(spark, SF_SMALL)
    # split the events into 4 files in arrival order: micro-batches follow arrival order
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn("_q", F.floor(F.col("event_id").bitwiseXOR(F.lit(7)) / 250))
    for i in range(4):
        ev.filter(F.col("_q") == i).drop("_q").coalesce(1).write.parquet(os.path.join(scratch, f"p{i}"))
        part = [f for f in os.listdir(os.path.join(scratch, f"p{i}")) if f.endswith(".parquet")][0]
        shutil.copy(os.path.join(scratch, f"p{i}", part), os.path.join(src, f"events-{i}.parquet"))
    stream = I.signal_events(spark.readStream.schema(DRIVER_EVENTS_SCHEMA).option("maxFilesPerTrigger", 1)
                             .parquet(src))
    out = os.path.join(scratch, "frags")
    q = ST.start_arrival_fragments(stream, HOUR, out, os.path.join(scratch, "ck"))
    q.awaitTermination(300)
    got = ST.read_arrival_fragments(spark, out)
    assert got.select("batch_id").distinct().count() == 4
    batch = Q.arrival_fragments(sig, HOUR)
    assert _rows(got, ["arrival_seq", "fragment_id"]) == _rows(batch, ["arrival_seq", "fragment_id"])


def test_metrics_publisher_equals_batch_series(spark, scratch):
    stream = X.ledger(L.signal_stream(spark, SF_SMALL))
    path = os.path.join(scratch, "ticks")
    q = TK.start_metrics_publisher(stream, path, os.path.join(scratch, "ck"))
    q.awaitTermination(300)
    got = TK.read_kpi_series(spark, path)
    batch = O.kpi_series(X.load_ledger(spark, SF_SMALL))
    cols = ["tick_us", "ingested_total", "processed_total", "dropped_total"]
    assert _rows(got, cols) == _rows(batch, cols)


def test_observe_reports_processing(spark, scratch):
    stream = L.observe_processing(X.ledger(L.signal_stream(spark, SF_SMALL)))
    q = (stream.writeStream.format("noop").option("checkpointLocation", os.path.join(scratch, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    metrics = [p["observedMetrics"].get("processing") for p in q.recentProgress if p.get("observedMetrics")]
    assert metrics and sum(m["events"] for m in metrics) == 1000


def _wire_file(spark, folder, name, rows):
    """One JSON-lines file of wire events (id, source, timestamp, payload text, seq)."""
    df = spark.createDataFrame(rows, "id string, source string, timestamp string, payload string, arrival_seq long") \
        .withColumn("event_type", F.lit("raw")).withColumn("tags", F.lit(None).cast("map<string,string>")) \
        .withColumn("correlation_id", F.lit(None).cast("string"))
    tmp = os.path.join(folder, "_tmp_" + name)
    df.coalesce(1).write.json(tmp)
    part = [f for f in os.listdir(tmp) if f.endswith(".json")][0]
    shutil.copy(os.path.join(tmp, part), os.path.join(folder, "in", name + ".json"))


def test_late_event_dropped_by_watermark_and_kept_by_fragments(spark, scratch):
    os.makedirs(os.path.join(scratch, "in"))
    files = [("a", "2024-01-01T00:10:00+00:00"), ("b", "2024-01-01T05:10:00+00:00"),
             ("c", "2024-01-01T06:10:00+00:00"), ("d", "2024-01-01T00:20:00+00:00")]   # d is late
    for seq, (name, ts) in enumerate(files):
        _wire_file(spark, scratch, name, [(name, "log", ts, '{"level": "INFO"}', seq)])
    stream = I.flatten_envelope(I.read_wire(spark, os.path.join(scratch, "in"), stream=True,
                                            max_files_per_trigger=1))
    q = (L.window_aggregates_stream(stream, HOUR, delay="0 seconds").writeStream.format("memory")
         .queryName("late_drop").outputMode("append").option("checkpointLocation", os.path.join(scratch, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    dropped = sum(op.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress
                  for op in p.get("stateOperators", []))
    assert dropped >= 1
    # the exact mode keeps the late event as a second fragment of the 00:00 window
    frags = Q.arrival_fragments(I.flatten_envelope(I.read_wire(spark, os.path.join(scratch, "in"))), HOUR) \
        .orderBy("arrival_seq").collect()
    assert [r["fragment_id"] for r in frags] == [1, 2, 3, 4]
    assert frags[0]["window_start"] == frags[3]["window_start"]


def test_progress_collector_sees_observed_metrics(spark, scratch):
    collector = TK.ProgressCollector(keep=5)
    spark.streams.addListener(collector)
    try:
        stream = L.observe_processing(X.ledger(L.signal_stream(spark, SF_SMALL)))
        q = (stream.writeStream.format("noop").option("checkpointLocation", os.path.join(scratch, "ck"))
             .trigger(availableNow=True).start())
        q.awaitTermination(300)
        import time
        for _ in range(50):
            if any(r["observed"] for r in collector.reports):
                break
            time.sleep(0.2)
        observed = [r["observed"]["processing"] for r in collector.reports if r["observed"]]
        assert observed and sum(o["events"] for o in observed) == 1000
        assert len(collector.reports) <= 5
    finally:
        spark.streams.removeListener(collector)


def test_default_checkpoint_under_shared_folder(spark, scratch):
    from windrose.session import checkpoint_dir, stream_checkpoint
    out = os.path.join(scratch, "ticks-default")
    ck = stream_checkpoint(spark, out)
    assert ck.startswith(checkpoint_dir(spark).rstrip("/"))
    q = TK.start_metrics_publisher(X.ledger(L.signal_stream(spark, SF_SMALL)), out)
    q.awaitTermination(300)
    assert TK.read_kpi_series(spark, out).count() > 0


def test_keyed_fragments_stream_equal_batch(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn("_q", F.floor(F.col("event_id").bitwiseXOR(F.lit(7)) / 300))
    for i in range(4):
        ev.filter(F.col("_q") == i).drop("_q").coalesce(1).write.parquet(os.path.join(scratch, f"p{i}"))
        part = [f for f in os.listdir(os.path.join(scratch, f"p{i}")) if f.endswith(".parquet")][0]
        shutil.copy(os.path.join(scratch, f"p{i}", part), os.path.join(src, f"events-{i}.parquet"))
    stream = I.signal_events(spark.readStream.schema(DRIVER_EVENTS_SCHEMA).option("maxFilesPerTrigger", 1)
                             .parquet(src))
    q = (ST.arrival_fragments_stream(stream, HOUR, keys=["source"]).writeStream.format("memory")
         .queryName("keyed_frags").outputMode("append").option("checkpointLocation", os.path.join(scratch, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    batch = Q.arrival_fragments(I.load_signal(spark, SF_SMALL), HOUR, keys=["source"])
    assert _rows(spark.table("keyed_frags"), ["arrival_seq", "fragment_id"]) == \
        _rows(batch, ["arrival_seq", "fragment_id"])


def test_admission_cap_stream_equal_batch(spark, scratch):
    from windrose.operators import observe as OB
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn("_q", F.floor(F.col("event_id").bitwiseXOR(F.lit(7)) / 300))
    for i in range(4):
        ev.filter(F.col("_q") == i).drop("_q").coalesce(1).write.parquet(os.path.join(scratch, f"p{i}"))
        part = [f for f in os.listdir(os.path.join(scratch, f"p{i}")) if f.endswith(".parquet")][0]
        shutil.copy(os.path.join(scratch, f"p{i}", part), os.path.join(src, f"events-{i}.parquet"))
    stream = I.signal_events(spark.readStream.schema(DRIVER_EVENTS_SCHEMA).option("maxFilesPerTrigger", 1)
                             .parquet(src))
    # 1-day buckets so that buckets span several micro-batches
    q = (ST.admission_cap_stream(stream, "1 day", merged_cap=10, source_cap=4).writeStream.format("memory")
         .queryName("cap_stream").outputMode("append").option("checkpointLocation", os.path.join(scratch, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    batch = OB.admission_cap(I.load_signal(spark, SF_SMALL), "1 day", merged_cap=10, source_cap=4)
    cols = ["arrival_seq", "accepted", "dropped"]
    assert _rows(spark.table("cap_stream"), cols) == _rows(batch, cols)


def test_live_view_with_processing_time_trigger(spark, scratch):
    """ST7 cadence: a processing-time trigger (the live mode) gives the same view."""
    stream = L.signal_stream(spark, SF_SMALL)
    path = os.path.join(scratch, "partials-live")
    q = L.start_live_partials(stream, HOUR, path, os.path.join(scratch, "ck"),
                              trigger={"processingTime": "1 second"})
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    view = L.read_live_view(spark, path, HOUR)
    batch = A.window_source_aggregates(I.load_signal(spark, SF_SMALL), HOUR)
    assert _rows(view, ["source", "count"]) == _rows(batch, ["source", "count"])


def test_stream_reads_a_folder_table(spark, scratch):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    events.repartition(3).write.parquet(os.path.join(scratch, "events.parquet"))
    q = (I.stream_events(spark, scratch).writeStream.format("memory").queryName("folder_events")
         .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    assert spark.table("folder_events").count() == events.count()


def test_a_failing_hook_does_not_stop_the_live_partials(spark, scratch):
    calls = []

    def hook(batch, batch_id):
        calls.append(batch_id)
        raise RuntimeError("hook")
    out = os.path.join(scratch, "live")
    q = L.start_live_partials(L.signal_stream(spark, SF_SMALL), HOUR, out, os.path.join(scratch, "ck"), after_batch=hook)
    q.awaitTermination(120)
    assert q.exception() is None and calls
    assert L.read_live_view(spark, out, HOUR).agg(F.sum("count")).first()[0] == 1000


# ---------------------------------------------------------------- commits, compaction, live metrics

def _split_events(spark, scratch, parts=5, quiet_user=None):
    """The events as several files, in order of event id, and one closing sentinel beside
    them; ``quiet_user``, if given, sends the first event and no other."""
    src = os.path.join(scratch, "parts")
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    if quiet_user is not None:
        opening = events.agg(F.min("event_id")).first()[0]
        events = events.withColumn("user_id", F.when(F.col("event_id") == opening, F.lit(quiet_user)).otherwise(F.col("user_id")))
    events.repartitionByRange(parts, "event_id").sortWithinPartitions("event_id").write.parquet(src)
    both = L.write_flush_sentinel(spark, src, os.path.join(scratch, "closing"), HOUR)
    # a stream takes files by their times, which are often equal to the millisecond
    files = sorted(os.path.join(src, f) for f in os.listdir(src) if f.endswith(".parquet"))
    first = min(map(os.path.getmtime, files)) - 60
    for i, f in enumerate(files):
        os.utime(f, (first + i, first + i))
    return src, both


def _stream(spark, path):
    return I.signal_events(spark.readStream.schema(DRIVER_EVENTS_SCHEMA).option("maxFilesPerTrigger", 1).parquet(path))


def _same(a, b, digits=6):
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    norm = lambda r: tuple(round(v, digits) if isinstance(v, float) else v for v in r)
    rows = lambda d: sorted((norm(r) for r in d.select(*cols).collect()), key=str)
    assert rows(a) == rows(b)


def test_published_history_equals_batch(spark, scratch):
    src, _ = _split_events(spark, scratch)
    led = X.ledger(_stream(spark, src))
    aggs = A.window_source_aggregates(X.processed_signal(I.load_signal(spark, SF_SMALL)), HOUR)
    agg_out = os.path.join(scratch, "aggs")
    aggs.select("window", "source").write.parquet(agg_out)
    path, seen = os.path.join(scratch, "kpi"), []
    TK.start_metrics_publisher(led, path, os.path.join(scratch, "ck"), window=HOUR,
                               after_batch=lambda _, i: seen.append(i)).awaitTermination(300)
    stream = spark.readStream.schema(spark.read.parquet(agg_out).schema).parquet(agg_out)
    TK.start_aggregate_publisher(stream, path, os.path.join(scratch, "ck2")).awaitTermination(300)
    assert len(seen) == 5
    batch = X.load_ledger(spark, SF_SMALL)
    _same(TK.read_kpi_history(spark, path), O.kpi_history(batch, aggs))
    records = A.window_records(X.processed_signal(I.load_signal(spark, SF_SMALL)), HOUR)
    mine = TK.read_window_records(spark, path)
    _same(mine, records.select(*mine.columns))
    _same(O.window_summary(mine).drop("last_window"), O.window_summary(records).drop("last_window"))


def test_sliding_rate_equals_ticks(spark, scratch):
    src, _ = _split_events(spark, scratch)
    # events exactly on ticks and on the closed old end, beside the driver's
    base = spark.read.parquet(src)
    edge = base.limit(40).withColumn("ts", F.expr("date_trunc('minute', ts)")).withColumn("event_id", F.col("event_id") + 10**6)
    both = os.path.join(scratch, "edge")
    base.unionByName(edge).coalesce(1).write.parquet(both)
    closing = L.write_flush_sentinel(spark, both, os.path.join(scratch, "edge-closing"), HOUR)
    stream = TK.rate_ticks_stream(_stream(spark, closing), "0 seconds", keys=["source"])
    out = os.path.join(scratch, "rates")
    (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", os.path.join(scratch, "ck"))
     .trigger(availableNow=True).start()).awaitTermination(300)
    want = O.rate_ticks(I.signal_events(spark.read.schema(DRIVER_EVENTS_SCHEMA).parquet(both)), keys=["source"])
    _same(spark.read.parquet(out), want)


def test_latency_ring_equals_batch(spark, scratch):
    src, _ = _split_events(spark, scratch)
    rows = []
    q = (ST.latency_ring_stream(X.ledger(_stream(spark, src)), max_samples=50).writeStream.outputMode("update")
         .foreachBatch(lambda b, i: rows.extend((i, *r) for r in b.collect()))
         .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    newest = {}
    for i, source, total, n, avg, p50, p95 in sorted(rows):
        newest[source] = (total, round(avg, 6), p50, p95)
        assert n <= 50
    led = X.load_ledger(spark, SF_SMALL)
    batch = O.latency_stats(led, keys=["source"], max_samples=50).join(
        O.processed_rows(led).groupBy("source").agg(F.count("*").alias("n")), "source").collect()
    assert newest == {r.source: (r.n, round(r.latency_avg, 6), r.latency_p50, r.latency_p95) for r in batch}
    assert len({i for i, *_ in rows}) == 5


def test_state_ends_with_the_watermark(spark, scratch):
    # the table's own users are all heard of within the last two days, so their states stay
    _, both = _split_events(spark, scratch, parts=4, quiet_user=10**6)
    stream = _stream(spark, both)
    q = (ST.anchored_windows_stream(stream, HOUR, keys=["user_id"], delay="2 days").writeStream.format("memory")
         .queryName("timed_windows").outputMode("append").option("checkpointLocation", os.path.join(scratch, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert sum(p["stateOperators"][0]["numRowsRemoved"] for p in q.recentProgress if p["stateOperators"]) > 0
    cols = ["arrival_seq", "user_id", "window_seq", "window_start_us"]
    got = spark.table("timed_windows").filter("arrival_seq >= 0")
    untimed = (ST.anchored_windows_stream(_stream(spark, both), HOUR, keys=["user_id"]).writeStream.format("memory")
               .queryName("untimed_windows").outputMode("append").option("checkpointLocation", os.path.join(scratch, "ck2"))
               .trigger(availableNow=True).start())
    untimed.awaitTermination(300)
    assert _rows(got, cols) == _rows(spark.table("untimed_windows").filter("arrival_seq >= 0"), cols)


def test_long_columns_beside_nulls_stay_exact_on_streams(spark, scratch):
    src = os.path.join(scratch, "big")
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    events.withColumn("user_id", F.when(F.col("event_id") % 4 != 0, F.col("event_id") % 3 + (1 << 60) + 1)).coalesce(1).write.parquet(src)
    q = (ST.anchored_windows_stream(_stream(spark, src), HOUR, keys=["source"], columns=["user_id"]).writeStream.format("memory")
         .queryName("big_longs").outputMode("append").option("checkpointLocation", os.path.join(scratch, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    want = I.signal_events(spark.read.parquet(src))
    assert _rows(spark.table("big_longs"), ["arrival_seq", "user_id"]) == _rows(want, ["arrival_seq", "user_id"])


def test_live_view_reads_a_bounded_number_of_files(spark, scratch):
    """Many batches of one key: generations replace them, and a replay changes nothing."""
    path = os.path.join(scratch, "live")
    calls = []

    def partial(i):
        return spark.createDataFrame([("log", float(i), i)], "source string, value_sum double, n long").select(
            F.timestamp_seconds(F.lit(0)).alias("window_start"), "source", F.lit("INFO").alias("label"), "value_sum",
            F.col("n").alias("value_n"), F.lit(0).cast("long").alias("ok_n"), "n")

    def write(batch, i):
        batch.withColumn("version", F.lit(i).cast("long")).coalesce(1).write.mode("overwrite").parquet(f"{path}/batch_id={i}")

    run = C.with_commits(path, write, lambda b, i: calls.append(i))
    for i in range(30):
        run(partial(i), i)
        if i % 10 == 9:
            L.compact_live_partials(spark, path)
    state, folders = L._live_state(spark, path)
    assert state["generation"] == 3 and len(folders) == 1
    assert len([n for n in C.children(spark, path) if n.startswith("batch_id=")]) <= 10
    before = L.read_live_view(spark, path, HOUR).collect()
    assert [r["count"] for r in before] == [29]
    run(partial(999), 29)          # a batch that is run again
    run(partial(999), 3)
    assert L.read_live_view(spark, path, HOUR).collect() == before and calls == list(range(30))
    run(partial(40), 30)
    assert [r["count"] for r in L.read_live_view(spark, path, HOUR).collect()] == [40]


def test_commit_marks_and_failing_hooks(spark, scratch):
    path, written, called = os.path.join(scratch, "c"), [], []

    def write(batch, i):
        written.append(i)
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={i}")

    def hook(batch, i):
        called.append(i)
        raise ValueError("a hook that fails")

    run = C.with_commits(path, write, hook)
    for i in (0, 1, 1, 0, 2):
        run(spark.range(i + 1), i)
    assert written == called == [0, 1, 2]
    spark.range(100).write.parquet(f"{path}/batch_id=3")        # written, but never committed
    assert C.committed(spark, path).count() == 6

    def broken(batch, i):
        raise RuntimeError("a batch that fails")
    with pytest.raises(RuntimeError):
        C.with_commits(path, broken, hook)(spark.range(1), 7)
    assert C.committed_ids(spark, path) == [0, 1, 2]
