"""Every registered query that has a SQL check, against DuckDB."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from tests.oracle import compare, connect

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_matches_sql(spark, con, name):
    n = compare(contract.queries()[name](spark, SF_DIR), con, contract.oracle_sql()[name])
    assert n > 0


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(contract.oracle_sql())))
def test_gives_rows(spark, name):
    assert contract.queries()[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0
