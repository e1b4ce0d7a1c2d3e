"""Queries that SQL can state, against DuckDB over the smallest tables."""

import os

import pytest

from millrace.llm import queries
from tests.compare import connect, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.mark.parametrize("name", list(queries.SQL))
def test_query(spark, name):
    assert differences(queries.QUERIES[name](spark, SF_DIR), connect(SF_DIR), queries.SQL[name]) == []
