"""Queries with a SQL form against DuckDB, at sf0.01."""

import pytest

from cohortkit.llm.queries import ORACLES, QUERIES
from tests.oracle import compare, duck_connect

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, name):
    ok, message = compare(QUERIES[name](spark, SF), duck_connect(SF), ORACLES[name])
    assert ok, message
