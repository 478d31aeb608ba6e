"""Every registered query against its SQL; those without SQL must give rows."""

import pytest
from compare import connect, differences

from postgauge.oracle import ORACLES
from postgauge.queries import QUERIES


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, data, con, name):
    assert differences(QUERIES[name](spark, data), con, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, data, name):
    assert QUERIES[name](spark, data).count() > 0
