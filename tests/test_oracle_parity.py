"""Every registered query against its SQL form in DuckDB."""

import os

import pytest

import __spark_entry__ as registry
from viewstats.registry.oracle import ORACLE
from viewstats.registry.queries import QUERIES
from compare import connect, differences

SF_DIR = os.environ.get("PARITY_SF_DIR", "/root/testdata/sf0.01")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data not present")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(registry.oracle_sql()) <= set(registry.queries())


def test_entry_runs(spark):
    result = registry.entry(spark)
    assert result.columns == ["date", "total_duration", "active_contracts", "unique_devices",
                              "avg_session_duration"]
    assert result.count() == 30


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) == []
