"""Every registered query against its DuckDB oracle, on whole tables."""

from __future__ import annotations

import pytest
from oracle_check import connect, differences

import __spark_entry__ as contract
from steadyline.plans.oracle import ORACLE
from steadyline.plans.registry import QUERIES

SF = "/root/testdata/sf0.01"



@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, ORACLE[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0
