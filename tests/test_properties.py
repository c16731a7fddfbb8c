"""Model checks: plain Python folds of the reference semantics vs the Spark plans,
on random (shuffled, out-of-order) inputs, with tiny buckets and Arrow batches so
that the two-level carries and the cross-batch state are exercised."""

import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import at, signal
from windrose.functions import scalar as S
from windrose.operators import sequence as Q

SETTINGS = dict(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck),
                phases=[Phase.explicit, Phase.reuse, Phase.generate])
T0 = at(0).replace(tzinfo=None)


def model_anchored(times, size):
    """The reference's fold: opener at first event; join while t < start + size."""
    out, start, opener = [], None, None
    for i, t in enumerate(times):
        if start is None or t >= start + size:
            start, opener = t, i
        out.append(opener)
    return out


def model_fragments(times, size):
    out, cur, fid = [], None, 0
    base = int(at(0).timestamp())          # windows are aligned to the epoch
    for t in times:
        ws = (base + t) - (base + t) % size
        if ws != cur:
            fid, cur = fid + 1, ws
        out.append(fid)
    return out


@pytest.fixture()
def small_batches(spark):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    yield
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


times_lists = st.lists(st.integers(min_value=0, max_value=60), min_size=1, max_size=40)


@settings(**SETTINGS)
@given(a=times_lists, b=times_lists, size=st.integers(min_value=1, max_value=15))
def test_anchored_matches_model(spark, small_batches, a, b, size):
    rows = [{"user_id": 1, "ts": at(t), "source": "log"} for t in a] + \
           [{"user_id": 2, "ts": at(t), "source": "log"} for t in b]
    order = list(range(len(rows)))
    random.Random(len(rows)).shuffle(order)          # interleave the two keys
    for seq, i in enumerate(order):
        rows[i]["arrival_seq"] = seq
    df = signal(spark, rows)
    got = {r["arrival_seq"]: r["window_seq"] for r in
           Q.anchored_windows(df, size, keys=["user_id"], bucket_rows=4).collect()}
    for key, times in ((1, a), (2, b)):
        seqs = sorted(r["arrival_seq"] for r in rows if r["user_id"] == key)
        by_seq = {r["arrival_seq"]: r for r in rows}
        ts_in_order = [int((by_seq[s]["ts"] - at(0)).total_seconds()) for s in seqs]
        expected = [seqs[i] for i in model_anchored(ts_in_order, size)]
        assert [got[s] for s in seqs] == expected


@pytest.mark.parametrize("size, width", [(1, 5), (3, 64), (7, 1), (40, 5), (500, 16)])
def test_key_that_never_pauses_crosses_buckets(spark, small_batches, size, width):
    # one key without any gap of ``size`` over many buckets, with older events in between
    rng = random.Random(size)
    now, times = 0.0, []
    for _ in range(300):
        now += rng.random() * min(size, 2)
        times.append(round(now - (rng.random() * 3 * size if rng.random() < 0.2 else 0), 3))
    df = signal(spark, [{"user_id": None, "ts": at(t), "source": "log"} for t in times])
    want = model_anchored([round(t * 1000) for t in times], size * 1000)
    got = Q.anchored_windows(df, size, keys=["user_id"], bucket_rows=width).orderBy("arrival_seq").collect()
    assert [r["window_seq"] for r in got] == want
    assert [r["opens_window"] for r in got] == [i == w for i, w in enumerate(want)]


def test_bucket_exits_agree_with_a_fold():
    rng = np.random.default_rng(3)
    for _ in range(200):
        t = np.unique(rng.integers(0, 80, rng.integers(1, 40)))
        size, before = int(rng.integers(1, 30)), int(t[0]) - int(rng.integers(1, 10))
        entries, exits = Q.bucket_exits(t, size, before)
        for start in range(before - size + 1, before + 1):       # every window that can be open at the edge
            last = start
            for x in t.tolist():
                last = x if x >= last + size else last
            i = int(np.searchsorted(t[entries], start + size))
            assert (t[exits[i]] if i < len(entries) else start) == last


@settings(**SETTINGS)
@given(times=times_lists, size=st.integers(min_value=1, max_value=15))
def test_openers_at_least_size_apart_and_first_kept(spark, small_batches, times, size):
    df = signal(spark, [{"ts": at(t), "source": "log"} for t in times])
    kept = Q.throttle(df, size, bucket_rows=3).orderBy("arrival_seq").collect()
    assert kept[0]["arrival_seq"] == 0
    secs = [int((r["ts"].replace(tzinfo=None) - T0).total_seconds()) for r in kept]
    assert all(b - a >= size for a, b in zip(secs, secs[1:]))


@settings(**SETTINGS)
@given(times=times_lists, size=st.integers(min_value=1, max_value=15))
def test_fragments_match_model_and_add_up(spark, times, size):
    df = signal(spark, [{"ts": at(t), "source": "sensor", "value": float(t)} for t in times])
    fr = Q.arrival_fragments(df, size, bucket_rows=3).orderBy("arrival_seq").collect()
    assert [r["fragment_id"] for r in fr] == model_fragments(times, size)
    # fragments added up by window equal the event-time windows
    per_ws = {}
    for r in fr:
        per_ws[r["window_start"]] = per_ws.get(r["window_start"], 0) + 1
    direct = {r["w"]: r["n"] for r in df.groupBy(S.floor_window("ts", size).alias("w")).count()
              .withColumnRenamed("count", "n").collect()}
    assert per_ws == direct


@settings(**SETTINGS)
@given(vals=st.lists(st.integers(min_value=-50, max_value=50), min_size=1, max_size=60),
       width=st.integers(min_value=1, max_value=7))
def test_prefix_sum_and_max(spark, vals, width):
    df = spark.createDataFrame([(i, v, i % 2) for i, v in enumerate(vals)], "s long, v long, k long")
    out = (Q.prefix_sum(Q.prefix_max(df, "v", "pm", seq="s", keys=["k"], bucket_rows=width),
                        "v", "ps", seq="s", keys=["k"], inclusive=False, bucket_rows=width)
           .orderBy("s").collect())
    for k in (0, 1):
        sub = [v for i, v in enumerate(vals) if i % 2 == k]
        rows = [r for r in out if r["k"] == k]
        if not sub:
            assert not rows
            continue
        assert [r["pm"] for r in rows] == list(np.maximum.accumulate(sub))
        assert [r["ps"] for r in rows] == [0] + list(np.cumsum(sub)[:-1])


@settings(**{**SETTINGS, "max_examples": 5})
@given(xs=st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), min_size=50, max_size=200))
def test_py_round_matches_python(spark, xs):
    ties = [v / 8 for v in range(-400, 400)] + [x / 1000 + 0.0005 for x in range(-300, 300)] + \
        [-0.0004, -0.0, 0.0004]
    vals = xs + ties
    df = spark.createDataFrame([(float(x),) for x in vals], "x double")
    got = [r["r"] for r in df.select(S.py_round("x", 3).alias("r")).collect()]
    want = [round(x, 3) for x in vals]
    assert got == want
    assert [math.copysign(1, g) for g in got] == [math.copysign(1, w) for w in want]


def _rows_per_bucket(df, target):
    b = Q.bucket_edges(df, "s", target)
    rows = Q._bucketed(df, "b", F.col("s"), b).groupBy("b").agg(F.count("*").alias("n"), F.min("s").alias("lo"), F.max("s").alias("hi"))
    out = rows.orderBy("b").collect()
    # buckets follow the order
    assert all(x.hi < y.lo for x, y in zip(out, out[1:]) if x.lo is not None)
    return out


@pytest.mark.parametrize("spread", ["sparse", "outlier_high", "outlier_low", "full_range", "two_clusters"])
def test_buckets_are_even_however_numbers_are_spread(spark, spread):
    n, target = 300_000, 1_000
    dense = spark.range(n)
    s = {"sparse": F.col("id") * 10**12 + 5, "outlier_high": F.when(F.col("id") == 0, 1 << 60).otherwise(F.col("id")),
         "outlier_low": F.when(F.col("id") == 0, -(1 << 62)).otherwise(F.col("id") + (1 << 60)),
         "full_range": F.when(F.col("id") == 0, -(1 << 63)).when(F.col("id") == 1, (1 << 63) - 1).otherwise(F.col("id")),
         "two_clusters": F.when(F.col("id") % 2 == 0, F.col("id")).otherwise(F.col("id") + (1 << 50))}[spread]
    counts = _rows_per_bucket(dense.select(s.cast("long").alias("s")), target)
    assert max(r.n for r in counts) <= 2 * target and len(counts) >= n // (2 * target)


def test_more_buckets_than_edges(spark, monkeypatch):
    monkeypatch.setattr(Q, "MAX_SPLITS", 16)
    df = spark.range(100_000).select(F.when(F.col("id") == 7, 1 << 60).otherwise(F.col("id") * 3).cast("long").alias("s"))
    counts = _rows_per_bucket(df, 500)
    assert len(counts) > 150 and sorted(r.n for r in counts)[-3] <= 1000


def test_scans_with_outlier_and_full_range(spark, monkeypatch):
    monkeypatch.setattr(Q, "DEFAULT_BUCKET_ROWS", 50)
    rng = random.Random(3)
    seqs = [-(1 << 63), *range(400), 1 << 60, (1 << 63) - 1]
    rows = [(s, rng.randint(-9, 9), rng.choice(["a", None])) for s in seqs]
    df = spark.createDataFrame(rows, "s long, v long, k string")
    assert len(Q.bucket_edges(df, "s", 50).edges) >= 5
    monkeypatch.setattr(Q, "bucket_edges", lambda d, s, target=50, plain=Q.bucket_edges: plain(d, s, target))
    out = Q.prefix_sum(df, "v", "ps", seq="s").orderBy("s").collect()
    assert [r["ps"] for r in out] == list(np.cumsum([v for _, v, _ in rows]))
    prev = Q.previous_value(df, "v", "before", "s", keys=["k"]).orderBy("s").collect()
    for k in ("a", None):
        vs = [v for _, v, kk in rows if kk == k]
        assert [r["before"] for r in prev if r["k"] == k] == [None, *vs[:-1]]


def test_rows_without_sequence_number_come_first(spark):
    rows = [{"ts": at(t), "source": "log", "value": float(t), "arrival_seq": s} for t, s in ((1, None), (2, 1), (3, 2))]
    df = signal(spark, [{**r, "event_id": i} for i, r in enumerate(rows)])
    assert df.filter("arrival_seq IS NULL").count() == 1
    fr = Q.arrival_fragments(df, "1 hour").collect()
    assert {r["fragment_id"] for r in fr} == {1}
    prev = {r["event_id"]: r["p"] for r in Q.previous_value(df, "value", "p", "arrival_seq").collect()}
    assert prev == {0: None, 1: 1.0, 2: 2.0}
    aw = {r["event_id"]: r["window_start_us"] for r in Q.anchored_windows(df, "1 hour").collect()}
    assert len(set(aw.values())) == 1


def test_long_columns_beside_nulls_stay_exact(spark, small_batches):
    ids = [(1 << 60) + 1, (1 << 60) + 2, (1 << 60) + 3, None]
    rows = [{"user_id": ids[i % 4], "ts": at(i * 7 % 50), "source": "log"} for i in range(40)]
    df = signal(spark, rows)
    for width in (1 << 20, 3):
        got = Q.anchored_windows(df, 5, keys=["user_id"], bucket_rows=width).collect()
        assert sorted(str(r["user_id"]) for r in got) == sorted(str(r["user_id"]) for r in rows)
        assert {r["arrival_seq"]: r["user_id"] for r in got} == {i: r["user_id"] for i, r in enumerate(rows)}
    unkeyed = Q.anchored_windows(df, 5).collect()
    assert {r["arrival_seq"]: r["user_id"] for r in unkeyed} == {i: r["user_id"] for i, r in enumerate(rows)}


@pytest.mark.parametrize("key", ["nan", "struct", "binary"])
def test_fold_takes_any_key_type(spark, small_batches, key):
    df = signal(spark, [{"user_id": i % 2, "ts": at(i), "source": "log"} for i in range(60)])
    made = {"nan": F.when(F.col("user_id") == 0, float("nan")).otherwise(1.0),
            "struct": F.struct(F.col("user_id").alias("a"), F.array("user_id").alias("b")),
            "binary": F.col("user_id").cast("string").cast("binary")}[key]
    want = {r["arrival_seq"]: r["window_seq"] for r in Q.anchored_windows(df, 6, keys=["user_id"], bucket_rows=7).collect()}
    got = Q.anchored_windows(df.withColumn("key", made), 6, keys=["key"], bucket_rows=7).collect()
    assert {r["arrival_seq"]: r["window_seq"] for r in got} == want


def test_buckets_narrower_than_a_window(spark, small_batches):
    """Many buckets inside one window, several pieces, keys that skip buckets."""
    rng = random.Random(8)
    rows, now = [], {0: 0.0, 1: 0.0, 2: 0.0}
    for _ in range(300):
        k = rng.choice([0, 0, 0, 1, 1, 2])
        now[k] += rng.random() * 3 + (200 if rng.random() < 0.01 else 0)
        rows.append({"user_id": k, "ts": at(round(now[k] - (rng.random() * 30 if rng.random() < 0.3 else 0), 3)), "source": "log"})
    df = signal(spark, rows)
    for size in (2, 60):
        got = {r["arrival_seq"]: r["window_seq"] for r in Q.anchored_windows(df, size, keys=["user_id"], bucket_rows=2).collect()}
        for k in now:
            seqs = [i for i, r in enumerate(rows) if r["user_id"] == k]
            want = model_anchored([round((rows[i]["ts"] - at(0)).total_seconds() * 1000) for i in seqs], size * 1000)
            assert [got[i] for i in seqs] == [seqs[w] for w in want]


def test_buckets_read_the_input_a_fixed_number_of_times(spark, small_batches):
    """Running max and pieces are computed once, however many steps read them."""
    seen = spark.sparkContext.accumulator(0)
    rows = signal(spark, [{"user_id": i % 3, "ts": at(i * 13 % 70 + i // 9), "source": "log"} for i in range(200)])

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    got = Q.anchored_windows(rows.mapInArrow(count, rows.schema), 5, keys=["user_id"], bucket_rows=8).collect()
    want = Q.anchored_windows(rows, 5, keys=["user_id"], bucket_rows=1 << 20).collect()
    assert {r["arrival_seq"]: r["window_seq"] for r in got} == {r["arrival_seq"]: r["window_seq"] for r in want}
    assert seen.value <= 2 * 200


def test_composed_tables_agree_with_a_fold(spark):
    """Composition of step tables against folding the maxima of both nodes."""
    rng = np.random.default_rng(12)
    for _ in range(4):
        t = np.unique(rng.integers(1, 400, 60)).astype(np.int64)
        size = int(rng.integers(5, 120))
        cut = int(rng.integers(5, len(t) - 5))
        rows = []
        for node, part, before in ((0, t[:cut], 0), (1, t[cut:], int(t[cut - 1]))):
            entries, exits = Q.bucket_exits(part, size, before)
            ends = part[entries]
            los = [before, *ends[:-1].tolist()]
            rows += [("k", 0, node, lo, int(hi), int(part[x]), int(part[x]), before) for lo, hi, x in zip(los, ends, exits)]
        df = spark.createDataFrame(rows, "k string, _piece long, _node long, _lo long, _hi long, _exit_t long, _exit_seq long, _before long")
        steps = sorted((r["_hi"], r["_exit_t"]) for r in Q.compose(df, size, ["k"]).collect())
        for start in range(-size + 1, 1):
            last = start
            for x in t.tolist():
                last = x if x >= last + size else last
            assert next((e for hi, e in steps if hi >= start + size), start) == last
