"""Every registered query gives the same rows in Spark and in DuckDB."""

from pathlib import Path

import pytest

import __spark_entry__ as registry
from checks.compare import differences, oracle_connection

FOLDER = registry.SMOKE_DIR
pytestmark = pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="the given tables are not here")


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(FOLDER)


def test_every_query_has_a_counterpart():
    assert registry._queries.keys() == registry._oracles.keys()
    assert registry.oracle_sql().keys() <= registry.queries().keys()


@pytest.mark.parametrize("name", list(registry.oracle_sql()))
def test_spark_and_duckdb_agree(spark, connection, name):
    assert differences(spark, connection, FOLDER, name) is None


def test_flagship(spark):
    assert registry.entry(spark).count() > 0
