"""Sources and sinks: routing with partition pruning, JSON wire round trip, multiplex."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from windrose.operators import aggregate as A
from windrose.sources import ingest as I
from windrose.sources import sinks as K


def test_route_write_read_prunes_partitions(spark):
    sig = I.load_signal(spark, SF_SMALL)
    path = os.path.join(tempfile.mkdtemp(prefix="windrose-route-"), "routed")
    I.write_routed(sig, path, mode="overwrite")
    logs = I.read_routed(spark, path, "log")
    plan = logs._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "log" in plan
    assert logs.count() == sig.filter(F.col("source") == "log").count()


def test_wire_round_trip(spark):
    env = I.to_envelope(I.load_signal(spark, SF_SMALL))
    path = os.path.join(tempfile.mkdtemp(prefix="windrose-wire-"), "wire")
    I.to_wire(env).write.json(path)
    back = I.flatten_envelope(I.read_wire(spark, path))
    a = A.window_source_aggregates(back, "1 hour").select("window", "source", "count", "success_rate")
    b = A.window_source_aggregates(I.flatten_envelope(env), "1 hour").select("window", "source", "count",
                                                                              "success_rate")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_multiplex_demultiplex(spark):
    sig = I.load_signal(spark, SF_SMALL)
    tagged = K.multiplex(event=sig.select("ts", "source"), metrics=sig.select("ts", "k"))
    tagged = tagged.unionByName(tagged.limit(3).withColumn("type", F.lit("other")))
    parts = K.demultiplex(tagged)
    assert parts["event"].count() == sig.count()
    assert parts["agg"].count() == 0
    assert parts["metrics"].count() == sig.count()


def test_envelope_defaults(spark):
    df = spark.createDataFrame([(None, None, None, None)],
                               "id string, source string, event_type string, tags map<string,string>")
    r = I.with_envelope_defaults(df, generate_ids=True).first()
    assert (r["source"], r["event_type"], r["tags"]) == ("feed", "raw", {})
    assert r["id"] is not None


def test_time_range_pushdown_reaches_scan(spark):
    sig = I.load_signal(spark, SF_SMALL)
    out = A.window_source_aggregates(sig, "1 hour", time_range=("2024-01-02 00:00:00", "2024-01-03 00:00:00"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(ts" in plan


def test_aggregated_events_payload_layout(spark):
    import json
    sig = I.load_signal(spark, SF_SMALL)
    aggs = A.window_source_aggregates(sig, "1 hour")
    ev = K.aggregated_events(aggs)
    rows = {r["source"]: json.loads(r["payload"]) for r in ev.filter(F.col("event_type") == "aggregated").collect()}
    assert set(rows["sensor"]) == {"aggregation", "metric", "value", "window"}
    assert set(rows["log"]) == {"aggregation", "levels", "window"}
    assert set(rows["feed"]) == {"aggregation", "actions", "success_rate", "window"}
    assert rows["log"]["window"]["start"].endswith("+00:00")
    total = sum(json.loads(r["payload"])["window"]["count"] for r in ev.collect())
    assert total == sig.count()


def _broker(spark, n=40):
    """Wire events in two partitions whose offsets are equal."""
    rows = [(f'{{"id": "{p}-{o}", "source": "{"log" if p else "feed"}", "timestamp": "2024-01-01T12:00:{o % 60:02d}Z", '
             f'"payload": "{{\\"level\\": \\"INFO\\", \\"action\\": \\"view\\", \\"x\\": {o}}}"}}', p, o)
            for o in range(n) for p in (0, 1)]
    return spark.createDataFrame(rows, "value string, partition int, offset long")


def test_partitions_with_equal_offsets_keep_every_row(spark):
    from windrose.operators import observe as O
    from windrose.operators import sequence as Q
    env = I.parse_broker(_broker(spark))
    flat = I.flatten_envelope(env)
    order = [(r.arrival_seq, r.id) for r in flat.orderBy("arrival_seq").collect()]
    assert [i for _, i in order] == [f"{p}-{o}" for o in range(40) for p in (0, 1)]
    assert len({s for s, _ in order}) == 80
    cap = O.admission_cap(flat, "1 minute", merged_cap=10, source_cap=4).collect()
    assert sum(r.accepted for r in cap) == 10 and len(cap) == 80
    assert [r.id for r in sorted(cap, key=lambda r: r.arrival_seq) if not r.dropped] == [f"{p}-{o}" for o in range(4) for p in (0, 1)]
    frags = Q.arrival_fragments(flat, "10 seconds", bucket_rows=1 << 18).collect()
    assert len(frags) == 80 and {r.fragment_id for r in frags} == {1, 2, 3, 4}


def test_arrival_order_raises_instead_of_wrapping(spark):
    for partition, offset in ((0, 1 << 47), (1 << 16, 0), (-1, 0)):
        df = spark.createDataFrame([("{}", partition, offset)], "value string, partition int, offset long")
        with pytest.raises(Exception, match="out of range"):
            I.parse_broker(df).collect()


def test_wire_keeps_unknown_fields_and_broken_payloads(spark):
    lines = ['{"id": "1", "source": "sensor", "payload": "{\\"value\\": 2.5, \\"metric\\": \\"t\\", \\"deep\\": {\\"a\\": [1, 7]}}"}',
             '{"id": "2", "source": "log", "payload": "{\\"level\\": \\"IN", "tags": {"k": "v"}}',
             '{"id": "3", "source": "log", "payload": "{\\"level\\": \\"INFO\\", \\"service\\": \\"s\\"}", "tags": {"level": "given"}}',
             '{"id": "4", "source": "feed"}']
    env = I.parse_lines(spark.createDataFrame([(x,) for x in lines], "line string"))
    got = {r.id: r for r in env.select("*", F.try_variant_get("payload_open", "$.deep.a[1]", "int").alias("deep"))
           .drop("payload_open").collect()}
    assert got["1"].deep == 7 and got["1"].payload.value == 2.5 and got["1"].tags == {"metric": "t"}
    assert got["2"].malformed and got["2"].payload is None and got["2"].payload_json == '{"level": "IN' and got["2"].tags == {"k": "v"}
    assert got["3"].tags == {"service": "s", "level": "given"} and got["3"].payload.service == "s"
    assert not got["4"].malformed and got["4"].payload is None and got["4"].tags == {}


def test_ledger_from_times(spark):
    rows = spark.createDataFrame([(1, 0, 5_500, None), (2, 0, None, None), (3, 7, 7, True)], "id int, r long, p long, dropped boolean")
    rows = rows.select("id", F.timestamp_micros("r").alias("received_at"), F.timestamp_micros("p").alias("processed_at"), "dropped")
    assert [(r.id, r.latency_ms, r.dropped) for r in I.ledger_from_times(rows).orderBy("id").collect()] == \
        [(1, 5.5, False), (2, None, False), (3, 0.0, True)]
    assert [r.dropped for r in I.ledger_from_times(rows, dropped=None).orderBy("id").collect()] == [False, True, False]
