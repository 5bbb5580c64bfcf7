"""Every registered query equals its SQL on the smallest benchmark tables."""

import duckdb
import pytest

import __spark_entry__ as driver
from auditmill.plans.oracle import ORACLE
from auditmill.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return connection


def test_every_query_of_the_audit_has_sql():
    assert set(QUERIES) == set(ORACLE) and set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", list(driver.oracle_sql()))
def test_query_equals_sql(spark, oracle, name):
    df = driver.queries()[name](spark, SF)
    columns = sorted(df.columns)
    cursor = oracle.execute(driver.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    expected = sorted(repr(tuple(row[names.index(c)] for c in columns)) for row in cursor.fetchall())
    assert sorted(repr(tuple(r)) for r in df.select(*columns).collect()) == expected


def test_entry(spark):
    assert driver.entry(spark).count() > 0
