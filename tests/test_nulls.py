"""Null keys, null times, equal sequence numbers and odd numbers: no row is lost or made."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import at, signal
from windrose.functions import scalar as S
from windrose.operators import observe as O
from windrose.operators import sequence as Q


@pytest.fixture()
def part_null(spark):
    return signal(spark, [{"arrival_seq": i, "user_id": None if i % 2 else 7, "ts": at(3600 * (i // 2)),
                           "source": None if i % 3 == 0 else "log", "value": float(i)} for i in range(12)])


@pytest.mark.parametrize("bucket_rows", ["auto", 2, 5])
def test_null_keys_keep_their_rows(part_null, bucket_rows):
    assert Q.prefix_sum(part_null, "value", "s", keys=["user_id"], bucket_rows=bucket_rows).count() == 12
    sums = {r.arrival_seq: r.s for r in
            Q.prefix_sum(part_null, "value", "s", keys=["user_id"], bucket_rows=bucket_rows).collect()}
    assert sums[10] == 0 + 2 + 4 + 6 + 8 + 10 and sums[11] == 1 + 3 + 5 + 7 + 9 + 11
    prev = {r.arrival_seq: r.p for r in
            Q.previous_value(part_null, "value", "p", "arrival_seq", ["user_id"], bucket_rows).collect()}
    assert prev == {i: (i - 2.0 if i > 1 else None) for i in range(12)}
    frag = {r.arrival_seq: r.fragment_id for r in
            Q.arrival_fragments(part_null, "1 hour", keys=["user_id"], bucket_rows=bucket_rows).collect()}
    assert frag == {i: i // 2 + 1 for i in range(12)}
    anchored = Q.anchored_windows(part_null.select("user_id", "arrival_seq", "ts"), "2 hours", keys=["user_id"],
                                  bucket_rows=bucket_rows).collect()
    assert Counter((r.user_id, r.window_seq) for r in anchored) == \
        Counter({(u, s): 2 for u, s in [(7, 0), (7, 4), (7, 8), (None, 1), (None, 5), (None, 9)]})
    kept = Q.throttle(part_null.select("source", "arrival_seq", "ts"), "1 hour", bucket_rows=bucket_rows).collect()
    assert any(r.source is None for r in kept)


@pytest.mark.parametrize("bucket_rows", [1, 2, 3, 100])
def test_null_times_do_not_depend_on_buckets(spark, bucket_rows):
    rows = signal(spark, [{"arrival_seq": i, "ts": t} for i, t in enumerate([at(0), None, at(18000), at(32400), None, None])])
    got = Q.arrival_fragments(rows, "1 hour", bucket_rows=bucket_rows).orderBy("arrival_seq").collect()
    assert [r.fragment_id for r in got] == [1, 2, 3, 4, 5, 5]
    assert Q.anchored_windows(rows.select("arrival_seq", "ts"), "1 hour", bucket_rows=bucket_rows).count() == 6


def test_rows_without_a_sequence_number_stay(spark):
    rows = spark.createDataFrame([(None, 1.0, at(0)), (1, 2.0, at(1)), (2, 3.0, at(2))],
                                 "arrival_seq long, value double, ts timestamp")
    assert Q.prefix_sum(rows, "value", "s").count() == 3
    assert Q.arrival_fragments(rows, "1 hour").count() == 3


def test_admission_with_equal_sequence_numbers(spark):
    rows = signal(spark, [{"arrival_seq": 5, "event_id": e, "ts": t, "source": s}
                          for e, t, s in [(1, at(0), "log"), (2, at(1), "log"), (3, at(2), "feed"), (4, None, "log"), (5, None, None)]])
    got = {r.event_id: (r.accepted, r.dropped) for r in O.admission_cap(rows, "1 hour", 2, 1).collect()}
    assert got == {1: (True, False), 2: (True, True), 3: (False, True), 4: (True, False), 5: (True, False)}


@pytest.mark.parametrize("text,want", [("1d", 0.0), ("1f", 0.0), ("0x1p3", 0.0), ("1_000", 1000.0), ("1__0", 0.0), (" 2.5 ", 2.5),
                                       (".5", 0.5), ("5.", 5.0), ("1e3", 1000.0), ("-inf", -math.inf), ("", 0.0), (None, 0.0)])
def test_safe_float_reads_texts_as_python_does(spark, text, want):
    assert spark.createDataFrame([(text,)], "x string").select(S.safe_float("x").alias("y")).first().y == want


def test_safe_float_of_booleans(spark):
    got = spark.createDataFrame([(True,), (False,), (None,)], "x boolean").select(S.safe_float("x").alias("y")).collect()
    assert [r.y for r in got] == [1.0, 0.0, 0.0]
    assert spark.createDataFrame([("true",)], "x string").select(S.safe_float("x").alias("y")).first().y == 0.0


@pytest.mark.parametrize("digits", [0, 3, 7])
def test_py_round_of_large_values(spark, digits):
    values = [1e13, 1e15 + 0.5, 123456789.123456789, 4503599627370495.5, 2.0 ** 60, -1e15 - 0.5, 0.5, 1.5, -2.5, 1e300]
    got = spark.createDataFrame([(v,) for v in values], "x double").select(S.py_round("x", digits).alias("y")).collect()
    assert [r.y for r in got] == [float(round(v, digits)) for v in values]
    assert F is not None
