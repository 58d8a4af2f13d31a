"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest
from check_one import compare, duck

import __spark_entry__ as entry_module
from tidemark.plans import all_queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(all_queries.QUERIES))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, SF, name) is None


def test_every_query_has_sql():
    assert set(all_queries.QUERIES) == set(all_queries.CHECKS)
    assert set(all_queries.QUERIES) <= set(entry_module.queries())


def test_entry_has_rows(spark):
    assert entry_module.entry(spark).count() > 0
