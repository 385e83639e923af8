"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from check import TABLES, rows_of
from queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(spark):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '/root/testdata/sf0.001/{name}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    df = contract.queries()[name](spark, sf_dir)
    relation = con.sql(contract.oracle_sql()[name])
    assert sorted(df.columns) == sorted(relation.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(relation.columns, relation.fetchall())
