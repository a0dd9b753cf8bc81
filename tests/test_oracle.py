"""Every registered query against its DuckDB oracle (as the driver does)."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from clinicflow.registry import QUERIES
from oracle_checks.compare import compare, duckdb_conn
from oracle_checks.sql import ORACLE

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duckdb_conn(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLE[name], SF)
    assert r["cols_match"], r
    assert r["rows_spark"] == r["rows_oracle"], r
    assert r["values_match"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["sort_order", "date_text", "ucs", "sss", "ofc", "cash"]
