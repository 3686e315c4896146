"""Every registered query against its SQL oracle at the smallest scale."""

from pathlib import Path

import pytest

import __spark_entry__ as contract
from gramloom.oracle import ORACLE
from gramloom.registry import QUERIES
from tools.check_oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="needs the given tables")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, connection, name):
    ok, rows, difference, _, _ = compare(spark, connection, SF_DIR, name)
    assert ok, difference
    assert rows > 0


def test_entry(spark):
    row = contract.entry(spark).head()
    assert row.perplexity > 1 and 0 < row.accuracy < 1
