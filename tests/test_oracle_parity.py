"""Every registered query equals its SQL oracle: names, types and all values."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from registered.oracles import ORACLES
from registered.queries import QUERIES
from tests.conftest import SF_DIR
from tests.parity import differences, oracle_connection


@pytest.fixture(scope="module")
def oracle():
    connection = oracle_connection(SF_DIR)
    yield connection
    connection.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= queries().items() and ORACLES.items() <= oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_parity(spark, oracle, name):
    assert differences(QUERIES[name](spark, SF_DIR), oracle, ORACLES[name]) == []


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
