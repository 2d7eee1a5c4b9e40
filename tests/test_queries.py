"""Every registered query against its SQL on DuckDB."""

import pytest
from oracle import compare, duck

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_sql(spark, connection, name):
    outcome, _ = compare(spark, connection, name, queries()[name], oracle_sql().get(name), SF_DIR)
    assert outcome.startswith(("ok", "rows-only")), outcome


def test_entry(spark):
    assert entry(spark).count() > 0
