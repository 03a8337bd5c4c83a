"""Every registered query beside its SQL check on the smallest given tables."""

from __future__ import annotations

import os

import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
#: The smallest tables hold nothing that these ask for; the larger ones do.
NOTHING_IN_SMALLEST = {"page1_users_by_role", "bkg10_create_inventory", "txt5_price_filter"}
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, FOLDER), duck, ORACLES[name]) is None
    if name not in NOTHING_IN_SMALLEST:
        assert duck.execute(ORACLES[name]).fetchone() is not None, "equal because both are empty"


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs_without_sql(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_checks_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() == 20
