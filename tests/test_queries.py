"""Every registered query gives the rows of its SQL, over whole tables."""

import os

import pytest

import __spark_entry__ as contract
from tests.compare import connect, same_rows

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")

QUERIES = contract.queries()
ORACLE = contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, con, name):
    assert same_rows(QUERIES[name](spark, FOLDER), con, ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    if FOLDER == "/root/testdata/sf0.001":
        assert contract.entry(spark).columns == ["phi"]
