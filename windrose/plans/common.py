"""Helpers shared by the named plans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from windrose.functions.scalar import col_of

HOUR = "1 hour"          # query window: the driver's events are minutes apart
HOUR_US = 3_600_000_000
DIGITS = 6               # doubles are compared rounded to 6 places


def us(c) -> Column:
    """Timestamp column -> BIGINT microseconds (time leaves every plan as micros)."""
    return F.unix_micros(col_of(c))


def r6(c) -> Column:
    return F.round(col_of(c), DIGITS)
