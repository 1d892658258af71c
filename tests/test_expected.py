import pytest

from tests.compare import compare, connect
from tidemark.plans.catalog import EXPECTED, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_same_rows_as_sql(spark, duck, name):
    assert compare(spark, duck, QUERIES[name], EXPECTED[name], SF) is None


def test_every_query_is_listed_once():
    assert set(EXPECTED) <= set(QUERIES)
    assert len(QUERIES) >= 60
