"""Every registered query against its SQL on DuckDB."""

import pytest

import __spark_entry__ as driver
from tests.conftest import SMALL_TABLES
from tests.oracle_check import compare, duck

STATEMENTS = driver.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return duck(SMALL_TABLES)


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_same_rows(spark, connection, name):
    df = driver.queries()[name](spark, SMALL_TABLES)
    assert compare(df.collect(), df.columns, connection.sql(STATEMENTS[name])) is None


def test_compaction_metrics(spark):
    rows = driver.queries()["compact_metrics"](spark, SMALL_TABLES).collect()
    assert len(rows) == 15
    assert all(row.added_files == 1 and row.rewritten_files >= 2 for row in rows)


def test_flagship(spark):
    assert driver.entry(spark).count() > 0
