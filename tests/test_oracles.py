"""Every query of the catalog against its SQL over the smallest test tables."""

import os

import pytest

from millrace import catalog, oracles
from tests.compare import connect, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = oracles.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, duck, name):
    assert differences(catalog.QUERIES[name](spark, SF_DIR), duck, SQL[name]) == []


def test_every_sql_has_its_query():
    assert set(SQL) == set(catalog.QUERIES)
