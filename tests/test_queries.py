"""Every registered query against its SQL counterpart on the small driver tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle import connect, differences, duck_table, spark_table

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, folder, duck, name):
    left = spark_table(QUERIES[name](spark, folder))
    assert differences(left, duck_table(duck, ORACLES[name]), tolerance=1e-9) == []
    assert left[1], "the query returns rows"


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, folder, name):
    assert QUERIES[name](spark, folder).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
