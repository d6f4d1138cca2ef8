"""Every registered query equals its DuckDB oracle (sf0.001 here; sf0.01 via verify_oracles.py)."""

import os

import pytest

import __spark_entry__ as E
from cohortkit.plans import registry
from tests.oracle import compare, duck_connect

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
KEYS = sorted(registry.queries())

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = registry.queries()[key](spark, SF)
    ok, msg = compare(df, con, registry.oracle_sql()[key])
    assert ok, msg
