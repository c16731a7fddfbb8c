"""Scalar expressions shared by batch and streaming plans.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so
it stays inside whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

import re
from datetime import timedelta
from typing import Union

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "duration_us", "col_of", "as_utc", "floor_window", "window_end", "window_bounds",
    "latency_ms", "iso_utc", "bool_text", "py_round", "round3", "string_map",
    "map_sum", "guarded_ratio", "lookup", "to_json_text", "from_json_text",
    "safe_float", "has_json_key", "strict_true",
]

Duration = Union[str, int, float, timedelta]

_UNITS_US = {
    "microsecond": 1, "millisecond": 1_000, "second": 1_000_000,
    "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000,
    "week": 7 * 86_400_000_000,
}


def duration_us(size: Duration, allow_zero: bool = False) -> int:
    """Window length in microseconds from ``"5 seconds"``, seconds or a timedelta."""
    if isinstance(size, timedelta):
        us = round(size.total_seconds() * 1_000_000)
    elif isinstance(size, (int, float)):
        us = round(size * 1_000_000)
    else:
        us = 0
        parts = re.findall(r"([0-9]*\.?[0-9]+)\s*([a-zA-Z]+)", size)
        if not parts and not (allow_zero and size.strip() in ("0", "")):
            raise ValueError(f"cannot parse duration {size!r}")
        for amount, unit in parts:
            unit = unit.lower().rstrip("s")
            unit = {"ms": "millisecond", "us": "microsecond", "sec": "second",
                    "min": "minute", "h": "hour", "hr": "hour", "d": "day"}.get(unit, unit)
            if unit not in _UNITS_US:
                raise ValueError(f"unknown duration unit {unit!r} in {size!r}")
            us += round(float(amount) * _UNITS_US[unit])
    if us < 0 or (us == 0 and not allow_zero):
        raise ValueError(f"duration must be positive, got {size!r}")
    return us


def col_of(c: Union[str, Column]) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_utc(ts: Union[str, Column]) -> Column:
    """a timestamp without zone read as UTC (session zone is pinned to UTC)."""
    return col_of(ts).cast("timestamp")


def floor_window(ts: Union[str, Column], size: Duration) -> Column:
    """start of the epoch-aligned tumbling window holding ``ts``.

    Floors toward minus infinity (Spark's window semantics), also before 1970.
    """
    us = F.unix_micros(col_of(ts))
    size_us = F.lit(duration_us(size))
    return F.timestamp_micros(us - F.pmod(us, size_us))


def window_end(start: Union[str, Column], size: Duration) -> Column:
    """window end = start + size."""
    return F.timestamp_micros(F.unix_micros(col_of(start)) + F.lit(duration_us(size)))


def window_bounds(ts: Union[str, Column], size: Duration) -> Column:
    """``struct(start, end)`` of the epoch-aligned window, like ``F.window``."""
    start = floor_window(ts, size)
    return F.struct(start.alias("start"), window_end(start, size).alias("end"))


def latency_ms(processed: Union[str, Column], event_time: Union[str, Column]) -> Column:
    """(processed - event time) in fractional milliseconds."""
    return (F.unix_micros(col_of(processed)) - F.unix_micros(col_of(event_time))) / F.lit(1000.0)


def iso_utc(ts: Union[str, Column]) -> Column:
    """ISO-8601 text with ``+00:00``; microseconds only when non-zero (as Python prints)."""
    c = col_of(ts)
    whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(c, ".SSSSSS")
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(
        F.concat(whole,
                 F.when(F.pmod(F.unix_micros(c), F.lit(1_000_000)) == 0, F.lit("")).otherwise(frac),
                 F.lit("+00:00")))


def bool_text(b: Union[str, Column]) -> Column:
    """boolean as Python prints it, ``True`` / ``False``."""
    return F.initcap(col_of(b).cast("string"))


def py_round(x: Union[str, Column], digits: int = 3) -> Column:
    """Round like Python's ``round(x, digits)``: half-even on the *exact* binary value.

    ``F.round`` rounds the shortest decimal text half-up, so 9.5475 (stored
    as 9.54749999...) gives 9.548 where Python gives 9.547.  Here the exact
    product ``x * 10**digits`` is recovered as ``p + err`` with Dekker's
    error-free product (Veltkamp split), and ``err`` settles the ties; all
    steps are plain double arithmetic, so the expression stays in codegen.
    """
    if not 0 <= digits <= 7:
        raise ValueError("digits must be in 0..7")
    c = col_of(x).cast("double")
    scale = float(10 ** digits)
    p = c * scale
    split = c * 134217729.0                     # 2**27 + 1
    hi = split - (split - c)
    lo = c - hi
    err = (hi * scale - p) + lo * scale
    fl = F.floor(p).cast("double")
    frac = p - fl
    up = (F.when(frac > 0.5, True).when(frac < 0.5, False)
          .when(err > 0, True).when(err < 0, False)
          .otherwise(F.pmod(fl, F.lit(2.0)) != 0))
    rounded = (fl + F.when(up, 1.0).otherwise(0.0)) / scale
    # Python keeps the sign of a negative value rounded to zero (-0.0)
    signed = F.when((rounded == 0.0) & (c < 0), F.lit(-0.0)).otherwise(rounded)
    # from 2**52 on the product has no fraction: the value is its own rounding
    return F.when(c.isNull() | F.isnan(c) | (F.abs(p) >= 4503599627370496.0) | (c == 0.0), c).otherwise(signed)


def round3(x: Union[str, Column]) -> Column:
    """round to 3 decimals with Python's semantics (see ``py_round``)."""
    return py_round(x, 3)


def string_map(*pairs: tuple[str, Union[str, Column]]) -> Column:
    """F8: ``map<string,string>`` from (key, value) pairs, leaving out null values."""
    if not pairs:
        return F.create_map().cast("map<string,string>")
    flat = []
    for key, value in pairs:
        flat += [F.lit(key), col_of(value).cast("string")]
    return F.map_filter(F.create_map(*flat), lambda k, v: v.isNotNull())


def map_sum(m: Union[str, Column]) -> Column:
    """sum of the values of a ``map<string,bigint>`` (0 for an empty map)."""
    return F.aggregate(F.map_values(col_of(m)), F.lit(0).cast("bigint"), lambda acc, x: acc + x)


def guarded_ratio(num: Union[str, Column], den: Union[str, Column], default: float = 0.0) -> Column:
    """num / den, ``default`` when den is 0 or null."""
    return F.coalesce(F.try_divide(col_of(num).cast("double"), col_of(den).cast("double")),
                      F.lit(default))


def lookup(c: Union[str, Column], default) -> Column:
    """Value with a default when missing."""
    return F.coalesce(col_of(c), F.lit(default))


def to_json_text(c: Union[str, Column]) -> Column:
    """record to JSON text."""
    return F.to_json(col_of(c))


def from_json_text(c: Union[str, Column], schema) -> Column:
    """JSON text to a typed record (no inference; mismatching types become null)."""
    return F.from_json(col_of(c), schema)


def safe_float(x: Union[str, Column], default: float = 0.0) -> Column:
    """P10: parse-safe numeric coercion, ``default`` for null or junk.

    Texts are numbers as Python reads them: digits with single underscores
    between them, a fraction, an exponent, inf and nan; no type suffixes, no
    hexadecimal.  A boolean counts as 1 or 0.
    """
    c = col_of(x)
    text = F.trim(c.cast("string"))
    number = text.rlike(rf"^[+-]?({_DIGITS}(\.({_DIGITS})?)?|\.{_DIGITS})([eE][+-]?{_DIGITS})?$")
    named = text.rlike(r"^(?i)([+-]?inf(inity)?|nan)$")
    parsed = F.when(number | named, F.replace(text, F.lit("_"), F.lit("")).try_cast("double"))
    truth = F.when(F.typeof(c) == "boolean", F.when(text == "true", 1.0).when(text == "false", 0.0))
    return F.coalesce(truth, parsed, F.lit(float(default)))


_DIGITS = r"[0-9]+(_[0-9]+)*"


def has_json_key(json_text: Union[str, Column], key: str) -> Column:
    """Key presence in a JSON object text (tells a missing key from a null value)."""
    return F.array_contains(F.json_object_keys(col_of(json_text)), F.lit(key))


def strict_true(b: Union[str, Column]) -> Column:
    """Success means exactly boolean true; null / missing is not success."""
    return F.coalesce(col_of(b) == F.lit(True), F.lit(False))
