"""Every registered query of the training-data operators that has SQL, against DuckDB."""

import pytest

from clinicflow.llm.queries import ORACLE, QUERIES
from oracle_checks.compare import compare, duckdb_conn

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duckdb_conn(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLE[name], SF)
    assert r["values_match"] and r["rows_spark"] == r["rows_oracle"], r
