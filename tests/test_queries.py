"""All warehouse queries against their DuckDB answers, and the contract around them."""

import pytest

import __spark_entry__ as entry_point
from checks import oracle, queries
from checks.compare import given_tables, oracle_rows, spark_rows

SF_DIR = "/root/testdata/sf0.001"
QUERIES = queries.queries()
ANSWERS = oracle.oracle_sql()


@pytest.fixture(scope="module")
def db():
    return given_tables(SF_DIR)


def test_every_query_has_an_answer():
    assert set(QUERIES) == set(ANSWERS)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ANSWERS) <= set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, db, name):
    assert spark_rows(QUERIES[name](spark, SF_DIR)) == oracle_rows(db, ANSWERS[name])


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
