"""Every registered query against its SQL on the small tables."""

import pytest
from oracle import database, difference

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    run, sql = queries()[name], oracle_sql().get(name)
    if sql is None:
        assert run(spark, SF_DIR).count() > 0
    else:
        assert difference(spark, con, name, run, sql, SF_DIR) is None
