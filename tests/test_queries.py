"""Every query with SQL agrees with DuckDB on the smallest tables; all run."""

import os

import pytest

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


def _normal(rows):
    def one(v):
        import pandas as pd

        if pd.isna(v):
            return "None"
        return str(int(v)) if isinstance(v, float) and v == int(v) else str(v)

    return sorted(tuple(one(v) for v in r) for r in rows)


def _core():
    import quern.catalog as catalog

    return catalog.queries(), catalog.oracle_sql()


@pytest.mark.parametrize("name", list(_core()[1]))
def test_against_sql(spark, name):
    import duckdb

    queries, sql = _core()
    got = queries[name](spark, SF).toPandas()
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f[:-8]} as select * from '{SF}/{f}'")
    want = con.execute(sql[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert _normal(got[columns].astype(object).values.tolist()) == _normal(want[columns].astype(object).values.tolist())


@pytest.mark.parametrize("name", ["compile_status", "compile_reasons", "stage_counts", "stage_ready_rows", "definition_catalog", "p4_found", "p4_variants"])
def test_runs(spark, name):
    assert _core()[0][name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
