"""Training-data queries that have SQL agree with DuckDB on the smallest tables."""

import os

import pytest

from quern.llm import queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_against_sql(spark, name):
    import duckdb

    got = queries.queries()[name](spark, SF).toPandas()
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f[:-8]} as select * from '{SF}/{f}'")
    want = con.execute(queries.oracle_sql()[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns) and len(got) > 0
    assert sorted(map(tuple, got[columns].values.tolist())) == sorted(map(tuple, want[columns].values.tolist()))
