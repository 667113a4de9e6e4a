"""Tier 3: every registered query vs its DuckDB oracle on the sf0.01 testdata."""

import os

import pytest

import __spark_entry__ as E
from tillroll.plans.registry import QUERIES
from tests.parity import compare, duck

SF = os.environ.get("TILLROLL_PARITY_SF", "/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="testdata not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_parity(spark, con, key):
    r = compare(spark, con, key, E.queries()[key], E.oracle_sql()[key], SF)
    assert r["cols"], (r["s_cols"], r["d_cols"])
    assert r["rows"], (r["n_spark"], r["n_duck"])
    assert r["values"], (r["s_sample"], r["d_sample"])
