"""Every registered query against its SQL, on the smallest test tables."""

import os

import pytest

from __spark_entry__ import entry
from tests.compare import database, differences
from tideline.plans.oracles import ORACLES
from tideline.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not available")


@pytest.fixture(scope="module")
def con():
    return database(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, con, name):
    ours, theirs, diff, _ = differences(spark, con, name, SF)
    assert diff == []
    assert ours == theirs


def test_entry(spark):
    assert entry(spark).count() == 4599
