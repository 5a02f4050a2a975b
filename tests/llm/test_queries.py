"""The queries that SQL can express against it, over the smallest tables."""

import pytest
from oracle import DATA, agree

from marketloom.llm import queries

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="the test tables are not here")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_agrees_with_its_sql(spark, name):
    agree(spark, queries.QUERIES[name], queries.ORACLES[name])
