"""Every registered query against its SQL, or for rows where it has none, at the smallest scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL
from tests.oracle import compare

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], SQL[name], SMALL) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 3


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_every_query_has_sql_but_those_that_sql_cannot_express():
    assert {n for n in set(QUERIES) - set(SQL) if n != "pipeline" and not n.startswith("op")} == set()
