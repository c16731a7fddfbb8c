"""Scalar functions (F1-F12, P7-P10) on literal rows."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from windrose.functions import scalar as S
from windrose.operators import transform as P


def _one(spark, col, ddl="x int", row=(1,)):
    return spark.createDataFrame([row], ddl).select(col.alias("r")).first()["r"]


def test_duration_parsing():
    assert S.duration_us("5 seconds") == 5_000_000
    assert S.duration_us("1 hour 30 minutes") == 5_400_000_000
    assert S.duration_us(timedelta(milliseconds=100)) == 100_000
    assert S.duration_us(2.5) == 2_500_000
    assert S.duration_us("0 seconds", allow_zero=True) == 0
    with pytest.raises(ValueError):
        S.duration_us("0 seconds")
    with pytest.raises(ValueError):
        S.duration_us("5 fortnights")


def test_iso_text_like_python(spark):
    ddl = "t string"
    whole = _one(spark, S.iso_utc(F.to_timestamp("t")), ddl, ("2024-01-01 12:00:05",))
    frac = _one(spark, S.iso_utc(F.to_timestamp("t")), ddl, ("2024-01-01 12:00:05.250000",))
    assert whole == "2024-01-01T12:00:05+00:00"
    assert frac == "2024-01-01T12:00:05.250000+00:00"


def test_bool_text_and_maps(spark):
    assert _one(spark, S.bool_text("b"), "b boolean", (True,)) == "True"
    assert _one(spark, S.bool_text("b"), "b boolean", (False,)) == "False"
    m = _one(spark, S.string_map(("a", F.lit("x")), ("b", F.lit(None))))
    assert m == {"a": "x"}
    assert _one(spark, S.map_sum(F.create_map().cast("map<string,bigint>"))) == 0
    assert _one(spark, S.map_sum(F.create_map(F.lit("a"), F.lit(2), F.lit("b"), F.lit(3)).cast(
        "map<string,bigint>"))) == 5


def test_guarded_ratio_lookup_and_safe_float(spark):
    assert _one(spark, S.guarded_ratio(F.lit(1), F.lit(0))) == 0.0
    assert _one(spark, S.guarded_ratio(F.lit(1), F.lit(4))) == 0.25
    assert _one(spark, S.lookup(F.lit(None).cast("string"), "UNKNOWN")) == "UNKNOWN"
    assert _one(spark, S.safe_float(F.lit("3.5"))) == 3.5
    assert _one(spark, S.safe_float(F.lit("junk"), 7.0)) == 7.0
    assert _one(spark, S.safe_float(F.lit(None).cast("string"))) == 0.0


def test_key_presence_tells_missing_from_null(spark):
    ddl = "j string"
    assert _one(spark, S.has_json_key("j", "value"), ddl, ('{"value": null}',)) is True
    assert _one(spark, S.has_json_key("j", "value"), ddl, ('{"level": "INFO"}',)) is False


def test_strict_true(spark):
    rows = spark.createDataFrame([(True,), (False,), (None,)], "b boolean")
    assert [r["r"] for r in rows.select(S.strict_true("b").alias("r")).collect()] == [True, False, False]


def test_latency_and_window_end(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00", "2024-01-01 00:00:01.5")], "a string, b string") \
        .select(F.to_timestamp("a").alias("a"), F.to_timestamp("b").alias("b"))
    r = df.select(S.latency_ms("b", "a").alias("ms"), S.window_end("a", "5 seconds").alias("e")).first()
    assert r["ms"] == 1500.0
    assert r["e"].strftime("%H:%M:%S") == "00:00:05"


def test_replace_nested_field(spark):
    df = spark.createDataFrame([((1.0, "x"),)], "p struct<value: double, level: string>")
    out = P.replace_field(df, "p.value", F.col("p.value") * 2).first()["p"]
    assert (out["value"], out["level"]) == (2.0, "x")


def test_json_round_trip(spark):
    from windrose.sources.schema import PAYLOAD_SCHEMA
    df = spark.createDataFrame([('{"value": 1.5, "success": true}',)], "j string")
    back = df.select(S.from_json_text("j", PAYLOAD_SCHEMA).alias("p")) \
        .select(S.to_json_text("p").alias("j2"), "p.value", "p.success").first()
    assert (back["value"], back["success"]) == (1.5, True)
    assert '"value":1.5' in back["j2"]
