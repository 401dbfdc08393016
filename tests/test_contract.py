"""Every registered query against its SQL in the checking database."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from tests.contract import compare, database, rows_of

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    problem = compare(spark, con, FOLDER, name, entry.queries()[name], entry.oracle_sql()[name])
    assert problem is None, problem


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_query_without_sql_runs(spark, name):
    _, rows = rows_of(entry.queries()[name](spark, FOLDER))
    assert rows


def test_entry(spark):
    assert entry.entry(spark).count() == 5
