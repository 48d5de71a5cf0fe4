"""Every registered query that has an SQL equivalent must give the same rows."""

import pytest
from compare import as_rows, differences, duck

import __spark_entry__ as entry_points

FOLDER = "/root/testdata/sf0.001"
QUERIES = entry_points.queries()
SQL = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    frame = QUERIES[name](spark, FOLDER)
    if name in SQL:
        assert differences(frame, connection, SQL[name]) is None
    else:
        assert frame.count() >= 0


def test_entry(spark, connection):
    rows, _ = as_rows(entry_points.entry(spark).toArrow())
    want, _ = as_rows(connection.sql(SQL["medallion_revenue"]).to_arrow_table())
    assert rows == want
