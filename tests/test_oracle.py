"""Every registered query against its SQL."""

import pytest
from oracle_check import compare, connect

import __spark_entry__ as contract
from workloads.oracle import ORACLE
from workloads.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    good, note = compare(spark, db, QUERIES[name], ORACLE[name], FOLDER)
    assert good, note


def test_entry(spark):
    assert contract.entry(spark).count() > 0
