import os
import sys
from datetime import datetime, timezone

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from windrose.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"

SIGNAL_DDL = ("arrival_seq long, event_id long, user_id long, k int, ts timestamp, source string, "
              "value double, level string, action string, success boolean")


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=4, app_name="windrose-tests")
    yield s
    s.stop()


def utc(h, m, s, us=0):
    return datetime(2024, 1, 1, h, m, s, us, tzinfo=timezone.utc)


def at(seconds: float):
    """A UTC instant ``seconds`` after 2024-01-01 12:00:00."""
    whole = int(seconds)
    return datetime(2024, 1, 1, 12, 0, 0, tzinfo=timezone.utc).replace(microsecond=0) + \
        __import__("datetime").timedelta(seconds=whole, microseconds=round((seconds - whole) * 1e6))


def signal(spark, rows):
    """Signal frame from dicts; missing fields are null, seq defaults to row order."""
    cols = [c.split()[0] for c in SIGNAL_DDL.split(", ")]
    data = []
    for i, r in enumerate(rows):
        r = dict(r)
        r.setdefault("arrival_seq", i)
        r.setdefault("event_id", r["arrival_seq"])
        data.append(tuple(r.get(c) for c in cols))
    return spark.createDataFrame(data, SIGNAL_DDL)
