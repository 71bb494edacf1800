"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest
from compare import compare, duck

import __spark_entry__ as entry
from editpulse.checks.registry import ORACLE as SQL
from editpulse.checks.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, connection, name):
    assert compare(spark, connection, QUERIES[name], SQL[name], SF) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
