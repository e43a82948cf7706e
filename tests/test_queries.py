"""Every registered query next to its SQL."""

from __future__ import annotations


import pytest

import __spark_entry__ as entry
from graphloom import plans
from tests.compare import connect, spark_rows, sql_rows

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(plans.queries())))
def test_query_gives_the_rows_of_its_sql(spark, folder, con, name):
    names, found = spark_rows(QUERIES[name](spark, folder))
    expected_names, expected = sql_rows(con, SQL[name])
    assert names == expected_names
    assert found == expected


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_its_query():
    assert set(SQL) <= set(QUERIES)
