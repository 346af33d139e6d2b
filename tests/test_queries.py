"""Every registered query against its SQL, or for rows and a stable schema."""

import os

import pytest
from checks import duck, mismatch

import __spark_entry__ as contract

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(FOLDER):
        pytest.skip("no test tables")
    return duck(FOLDER)


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark, con):
    assert contract.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, con, name):
    assert mismatch(QUERIES[name](spark, FOLDER), con, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    assert df.columns and df.count() > 0
