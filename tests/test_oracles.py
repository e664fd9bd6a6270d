"""Registered queries against their oracle text, on the smallest tables."""

import pytest

from check_oracle import compare, database
from geonet.queries import registry

SF = "/root/testdata/sf0.001"
FOUND = registry()


@pytest.fixture(scope="module")
def con():
    return database(SF)


@pytest.mark.parametrize("name", sorted(FOUND))
def test_query(spark, con, name):
    fn, sql = FOUND[name]
    _, problem = compare(spark, con, SF, fn, sql)
    assert problem is None, problem
