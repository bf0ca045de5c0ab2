import pytest

from tests.oracle import assert_same
from voxloom.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, name):
    d = "/root/testdata/sf0.001"
    assert assert_same(catalog.QUERIES[name](spark, d), catalog.ORACLES[name], d) > 0


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
