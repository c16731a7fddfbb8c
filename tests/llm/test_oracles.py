"""The corpus queries that SQL can express, against DuckDB on sf0.001."""

import duckdb
import pytest

from windrose.llm.oracle import ORACLE
from windrose.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.sql(ORACLE[name])
    columns = sorted(want.columns)
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == columns
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(want.select(*columns).fetchall())
