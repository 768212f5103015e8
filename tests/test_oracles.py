import pytest
from compare import compare

from tokenmill.plans.oracles import ORACLES
from tokenmill.plans.queries import QUERIES


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_oracle(spark, tiny, name):
    assert compare(spark, tiny, name, QUERIES[name], ORACLES[name]) == ""
