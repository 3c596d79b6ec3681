"""Every catalogue query against its DuckDB twin on the smallest driver tables
(row count, column types and order-insensitive values must match)."""

import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not available")
def test_catalogue_matches_duckdb(spark):
    import __spark_entry__ as E
    from oracle_compare import compare, duck
    con = duck(SF)
    qs, sqls = E.queries(), E.oracle_sql()
    failures = {}
    for name in sorted(sqls):
        probs, _, _ = compare(spark, con, name, qs[name], sqls[name], SF)
        if probs:
            failures[name] = probs
    assert not failures, failures


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not available")
def test_rows_only_queries_run(spark):
    import __spark_entry__ as E
    for name in sorted(set(E.queries()) - set(E.oracle_sql())):
        assert E.queries()[name](spark, SF).count() > 0, name


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not available")
def test_entry(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["station", "ts", "v"]
