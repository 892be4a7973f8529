"""Every query with SQL gives the SQL's rows."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_results import compare, connect


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, con, folder, name):
    status, text, _ = compare(spark, con, folder, name, queries()[name], oracle_sql()[name])
    assert status == "ok", text


def test_entry_runs(spark):
    assert entry(spark).count() == 3


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())
