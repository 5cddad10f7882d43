"""Every registered query against its oracle SQL on the smallest tables."""

import pytest

import __spark_entry__
from oddsline.plans.catalog import ORACLES, QUERIES
from tests.conftest import DATA
from tests.oracle import connect, differences

FOLDER = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert differences(QUERIES[name](spark, FOLDER), con, ORACLES[name]) == []
