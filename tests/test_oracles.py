"""Every registered query against its SQL counterpart."""

from __future__ import annotations

import pytest
from oracle_check import connect, differences

import __spark_entry__ as entry
from registry.duckdb_sql import ORACLES
from registry.spark_queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_oracle(spark, con, name):
    assert differences(spark, con, entry.queries()[name], entry.oracle_sql()[name], SF) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
