"""Plan-level guarantees for every registered query (checked at sf0.001 with broadcasts disabled)."""

import os
import re

import pytest

import __spark_entry__ as E
from tillroll.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="testdata not present")


@pytest.fixture(scope="module")
def plans(spark):
    old = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    for k, v in NO_BROADCAST.items():
        spark.conf.set(k, v)
    out = {}
    for key, fn in ((k, E.queries()[k]) for k in QUERIES):
        df = fn(spark, SF)
        df.collect()
        qe = df._jdf.queryExecution()
        out[key] = (qe.executedPlan().toString(), qe.optimizedPlan().toString())
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return out


def test_no_nested_loop_or_cartesian(plans):
    bad = [k for k, (p, _) in plans.items() if "NestedLoop" in p or "CartesianProduct" in p]
    assert not bad


def test_no_python_evaluation(plans):
    bad = [k for k, (p, _) in plans.items() if re.search(r"BatchEvalPython|ArrowEvalPython|PythonUDF", p)]
    assert not bad


def test_no_broadcast_hints(plans):
    bad = [k for k, (_, logical) in plans.items() if "ResolvedHint" in logical or "strategy=broadcast" in logical]
    assert not bad


def test_purchase_filter_pushed_and_columns_pruned(plans):
    plan = plans["L01"][0]
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "events" in line]
    assert scans
    for line in scans:
        assert "EqualTo(event_type,purchase)" in line
        schema = re.search(r"ReadSchema: struct<([^>]*)>", line).group(1)
        assert "event_id" not in schema and "value:" not in schema


def test_lineitem_scans_read_only_needed_columns(plans):
    for key in ("A01", "D01", "C02"):
        for line in plans[key][0].splitlines():
            if "FileScan parquet" in line and "lineitem" in line:
                schema = re.search(r"ReadSchema: struct<([^>]*)>", line).group(1)
                assert "l_comment" not in schema and "l_extendedprice" not in schema and "l_shipdate" not in schema
