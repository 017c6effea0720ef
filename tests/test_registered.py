"""Every registered query against its SQL on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as registered
from tools.check import database, difference

FOLDER = "/root/testdata/sf0.001"
QUERIES = registered.own_queries()
STATEMENTS = {k: v for k, v in registered.oracle_sql().items() if k in QUERIES}

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    return database(FOLDER)


def test_every_statement_has_a_query():
    assert set(registered.oracle_sql()) <= set(registered.queries())
    assert set(QUERIES) == set(STATEMENTS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    got = QUERIES[name](spark, FOLDER).toPandas()
    if name in STATEMENTS:
        assert difference(got, db.execute(STATEMENTS[name]).df()) == ""


def test_entry(spark):
    assert registered.entry(spark).columns == ["doc_id", "lang", "source"]
