import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

from check import rows_of
from tarmac.oracles import ORACLES
from tarmac.queries import QUERIES


@pytest.fixture(scope="module")
def sql(tables):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW events AS SELECT * FROM '{tables}/events.parquet'")
    return db


def test_entry(spark):
    assert entry(spark).count() == 598


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, tables, sql, name):
    frame = queries()[name](spark, tables)
    result = sql.execute(oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(frame.columns)
    assert rows_of(frame.columns, frame.collect()) == rows_of(columns, result.fetchall())
