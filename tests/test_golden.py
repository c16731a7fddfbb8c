"""Golden cases G1-G12 (the reference's tests) and E1-E13 (derived from its code)."""

from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import at, signal
from windrose.functions import scalar as S
from windrose.operators import aggregate as A
from windrose.operators import observe as O
from windrose.operators import sequence as Q
from windrose.operators import transform as P
from windrose.sources import ingest as I


def _fragments(df, size="5 seconds"):
    out = (Q.arrival_fragments(df, size, bucket_rows=2)
           .groupBy("fragment_id", "window_start").agg(F.count(F.lit(1)).alias("n"))
           .orderBy("fragment_id").collect())
    return [(r["window_start"], r["n"]) for r in out]


def test_g1_window_closes_on_change(spark):
    df = signal(spark, [{"source": "sensor", "ts": at(s), "value": 1.0} for s in (0, 4, 5)])
    frags = _fragments(df)
    assert frags[0][1] == 2
    assert frags[0][0].replace(tzinfo=None) == datetime(2024, 1, 1, 12, 0, 0)
    assert frags[1][1] == 1 and frags[1][0].replace(tzinfo=None) == datetime(2024, 1, 1, 12, 0, 5)


def test_g2_flush_emits_open_window_once(spark):
    df = signal(spark, [{"source": "sensor", "ts": at(s), "value": 1.0} for s in (1, 2)])
    assert [n for _, n in _fragments(df)] == [2]


def test_g3_predicate_keeps_only_matching(spark):
    df = signal(spark, [{"source": "sensor", "ts": at(s), "value": v} for s, v in ((0, 1.0), (1, 10.0))])
    out = P.filter_events(df, F.col("value") >= 10).collect()
    assert [r["value"] for r in out] == [10.0]


def test_g4_mapper_doubles(spark):
    df = signal(spark, [{"source": "sensor", "ts": at(0), "value": 3.0}])
    assert P.map_events(df, {"value": F.col("value") * 2}).first()["value"] == 6.0


def test_g5_sensor_mean(spark):
    df = signal(spark, [{"source": "sensor", "ts": at(s), "value": v} for s, v in ((0, 10.0), (1, 20.0))])
    r = A.window_source_aggregates(df, "5 seconds").first()
    assert (r["aggregation"], r["metric"], r["value"], r["count"]) == ("avg", "sensor.value", 15.0, 2)


def test_g6_log_levels(spark):
    df = signal(spark, [{"source": "log", "ts": at(i), "level": lv} for i, lv in enumerate(["INFO", "ERROR", "INFO"])])
    r = A.window_source_aggregates(df, "5 seconds").first()
    assert r["aggregation"] == "count_by_level" and dict(r["counts"]) == {"INFO": 2, "ERROR": 1}


def test_g7_feed_actions_and_rate(spark):
    rows = [("login", True), ("login", False), ("click", True)]
    df = signal(spark, [{"source": "feed", "ts": at(i), "action": a, "success": s} for i, (a, s) in enumerate(rows)])
    r = A.window_source_aggregates(df, "5 seconds").first()
    assert dict(r["counts"]) == {"login": 2, "click": 1}
    assert r["success_rate"] == pytest.approx(2 / 3, abs=1e-9)


def test_g8_split_by_source(spark):
    df = signal(spark, [{"source": s, "ts": at(0), "value": 1.0 if s == "sensor" else None,
                         "level": "INFO" if s == "log" else None, "action": "x" if s == "feed" else None}
                        for s in ("sensor", "log", "feed")])
    out = A.window_source_aggregates(df, "5 seconds").orderBy("emission_order").collect()
    assert [r["source"] for r in out] == ["sensor", "log", "feed"]


def test_g9_admission_with_null_timestamp(spark):
    df = signal(spark, [{"source": "log", "ts": None}, {"source": "log", "ts": None}])
    out = O.admission_cap(df, "5 seconds", merged_cap=1).orderBy("arrival_seq").collect()
    assert [r["accepted"] for r in out] == [True, False]


@pytest.mark.parametrize("ts,size,expected", [
    ("2024-01-01 12:00:10", "5 seconds", "2024-01-01 12:00:10"),
    ("2024-01-01 12:00:12", "5 seconds", "2024-01-01 12:00:10"),
    ("1970-01-01 00:00:09", "10 seconds", "1970-01-01 00:00:00"),
])
def test_g10_g12_floor(spark, ts, size, expected):
    df = spark.createDataFrame([(ts,)], "t string").select(F.to_timestamp_ntz("t").alias("t"))
    out = df.select(S.floor_window(S.as_utc("t"), size).alias("w")).first()["w"]
    assert out.strftime("%Y-%m-%d %H:%M:%S") == expected


def test_e1_late_event_fragments(spark):
    df = signal(spark, [{"source": "sensor", "ts": at(s), "value": 1.0} for s in (1, 2, 6, 3, 7, 12)])
    got = [((w - at(0).replace(tzinfo=None) if w.tzinfo is None else w - at(0)).seconds, n) for w, n in _fragments(df)]
    assert got == [(0, 2), (5, 1), (0, 1), (5, 1), (10, 1)]


def _anchored(spark, seconds, size="5 seconds"):
    df = signal(spark, [{"source": "sensor", "ts": at(s), "user_id": 1} for s in seconds])
    out = Q.anchored_windows(df, size, keys=["user_id"], bucket_rows=2).orderBy("arrival_seq").collect()
    groups = {}
    for r in out:
        groups.setdefault(r["window_seq"], []).append(seconds[r["arrival_seq"]])
    return [groups[k] for k in sorted(groups)]


def test_e2_anchored(spark):
    assert _anchored(spark, [3, 7, 8, 9, 14]) == [[3, 7], [8, 9], [14]]


def test_e3_anchored_older_event_joins(spark):
    assert _anchored(spark, [10, 4, 14, 15]) == [[10, 4, 14], [15]]


def test_e4_sensor_without_value(spark):
    df = signal(spark, [{"source": "sensor", "ts": at(s)} for s in (0, 1)])
    r = A.window_source_aggregates(df, "5 seconds").first()
    assert r["value"] is None and r["count"] == 2


def test_e5_missing_level_is_unknown(spark):
    df = signal(spark, [{"source": "log", "ts": at(0)}])
    assert dict(A.window_source_aggregates(df, "5 seconds").first()["counts"]) == {"UNKNOWN": 1}


def test_e6_strict_success_from_json(spark, tmp_path):
    payloads = ['{"action": "a", "success": true}', '{"action": "a", "success": 1}',
                '{"action": "a", "success": "true"}', '{"action": "a"}']
    raw = spark.createDataFrame([(str(i), "feed", "raw", "2024-01-01T12:00:00+00:00", p, i)
                                 for i, p in enumerate(payloads)],
                                "id string, source string, event_type string, timestamp string, payload string, "
                                "arrival_seq long").withColumn("tags", F.lit(None).cast("map<string,string>")) \
        .withColumn("correlation_id", F.lit(None).cast("string"))
    env = I.parse_wire(raw)
    flat = I.flatten_envelope(env)
    r = A.window_source_aggregates(flat, "5 seconds").first()
    assert r["success_rate"] == pytest.approx(0.25)


def test_e7_e8_nearest_rank(spark):
    df = spark.createDataFrame([(float(x),) for x in range(1, 11)], "v double")
    lo = O.nearest_rank(df, "v", mode="floor").first()
    hi = O.nearest_rank(df, "v", mode="ceil").first()
    assert (lo["p50"], lo["p95"], lo["avg"]) == (5.0, 9.0, 5.5)
    assert (hi["p50"], hi["p95"]) == (6.0, 10.0)


def test_e9_trailing_rate_closed_at_old_end(spark):
    df = signal(spark, [{"source": "log", "ts": at(s)} for s in (0, 4, 10)])
    out = O.trailing_rate(df, span="10 seconds").orderBy("arrival_seq").collect()
    assert out[-1]["rate_eps"] == pytest.approx(0.3)


def test_e10_drop_ratios(spark):
    led = spark.createDataFrame([(i >= 8,) for i in range(10)], "dropped boolean")
    r = O.drop_ratios(led).first()
    assert (r["drop_ratio_ingested"], r["drop_ratio_processed"]) == (0.2, 0.25)


def test_e11_throttle(spark):
    ms = [0, 50, 100, 190, 200]
    df = signal(spark, [{"source": "log", "ts": at(m / 1000)} for m in ms])
    out = Q.throttle(df, "100 milliseconds", bucket_rows=2).orderBy("arrival_seq").collect()
    assert [ms[r["arrival_seq"]] for r in out] == [0, 100, 200]


def test_e12_history_dedup(spark):
    df = spark.createDataFrame([(1, "A"), (2, "A"), (3, "B"), (4, "A")], "t long, id string")
    out = O.dedup_consecutive(df, ["id"], order="t", bucket_rows=2).orderBy("t").collect()
    assert [r["id"] for r in out] == ["A", "B", "A"]


def test_e13_empty_inputs(spark):
    empty = signal(spark, [{"source": "log", "ts": at(0)}]).limit(0)
    with pytest.raises(PySparkException):
        A.whole_envelope(empty).collect()
    led = spark.createDataFrame([], "arrival_seq long, source string, processed_at timestamp, latency_ms double, "
                                    "dropped boolean")
    lat = O.latency_stats(led).first()
    assert (lat["latency_avg"], lat["latency_p50"], lat["latency_p95"]) == (None, None, None)
    r = O.drop_ratios(led).first()
    assert (r["drop_ratio_ingested"], r["drop_ratio_processed"]) == (0.0, 0.0)


def test_x3_pandas_aggregator_fallback(spark):
    df = signal(spark, [{"source": "sensor", "ts": at(s), "value": v} for s, v in ((0, 1.0), (1, 4.0), (7, 2.0))])

    def spread(pdf):
        import pandas as pd
        return pd.DataFrame({"window_start": [pdf["window_start"].iloc[0]], "source": [pdf["source"].iloc[0]],
                             "spread": [pdf["value"].max() - pdf["value"].min()]})
    out = A.aggregate_with(df, "5 seconds", spread, schema="window_start timestamp, source string, spread double")
    assert sorted(r["spread"] for r in out.collect()) == [0.0, 3.0]
    cols = A.aggregate_with(df, "5 seconds", {"spread": F.max("value") - F.min("value")})
    assert sorted(r["spread"] for r in cols.collect()) == [0.0, 3.0]
