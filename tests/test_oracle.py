"""Every registered query against its SQL."""

import os

import pytest

import __spark_entry__
from foldmill import workload
from oracle import connect, differences

SF_DIR = os.environ.get("FOLDMILL_SF_DIR", "/root/testdata/sf0.001")
ORACLES = workload.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, connection, name):
    assert differences(__spark_entry__.queries()[name](spark, SF_DIR), connection, ORACLES[name]) == []


def test_every_query_has_sql():
    assert {name for name in set(workload.queries()) - set(ORACLES)} == set()


def test_entry_has_rows(spark):
    assert __spark_entry__.entry(spark).count() == 10
