"""Registered queries of the subpackage against their SQL on the smallest tables."""

import oracle
import pytest

from socigrain.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    assert oracle.compare(queries.QUERIES[name](spark, SF), oracle.connect(SF), queries.SQL[name]) == ""
