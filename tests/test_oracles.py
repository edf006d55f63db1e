"""Every registered query against its SQL on the same tables."""

import duckdb
import pytest
from compare import rows_of
from conftest import SF_DIR

import __spark_entry__ as driver

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_query_equals_sql(spark, duck, name):
    result = driver.queries()[name](spark, SF_DIR)
    assert len(set(result.columns)) == len(result.columns)
    frame = result.toPandas()
    sql = driver.oracle_sql().get(name)
    if sql is None:
        assert len(frame) > 0
        return
    columns, rows = rows_of(frame)
    expected_columns, expected = rows_of(duck.execute(sql).fetch_df())
    assert columns == expected_columns
    assert len(rows) == len(expected)
    assert rows == expected


def test_entry(spark):
    assert driver.entry(spark).count() > 0
