import pytest

from corvane.plans import catalogue
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    compare(spark, con, name, catalogue.queries()[name], catalogue.oracle_sql()[name], SF)


def test_every_query_has_sql():
    assert set(catalogue.queries()) == set(catalogue.oracle_sql())
