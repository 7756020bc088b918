"""Every registered query against its SQL equal, over whole tables."""

from pathlib import Path

import pytest

from compare import compare, connect
from scalargrid.plans.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no benchmark tables")


@pytest.fixture(scope="module")
def duck():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    difference = compare(QUERIES[name](spark, SF_DIR), duck, ORACLES[name])
    assert difference is None, difference
