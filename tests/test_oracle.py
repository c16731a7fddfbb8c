"""Every named plan of the catalog against its DuckDB oracle (the driver's correctness
gate) on sf0.001; the corpus queries have tests of their own in tests/llm."""

import math

import duckdb
import pandas as pd
import pytest

from conftest import SF_SMALL
from __spark_entry__ import entry, oracle_sql, queries
from windrose.plans.catalog import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "item"):
        v = v.item()
    return round(v, 6) if isinstance(v, float) else v


def _rows(pdf):
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False)]
    return cols, sorted(rows, key=repr)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(queries())
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    got = queries()[name](spark, SF_SMALL).toPandas()
    want = duck.sql(oracle_sql()[name]).df()
    c1, r1 = _rows(got)
    c2, r2 = _rows(want)
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "source" in df.columns
