"""Plans, as they are for large tables (no broadcast by size)."""

import re

import pytest

from lumenmart.plans.registry import QUERIES
from lumenmart.plans.star import Star
from tests.conftest import SF

EAGER = ("stream", "stored", "dq_suite", "limited", "append_other", "watermark", "json_source")


@pytest.fixture(scope="module")
def plans(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    out = {}
    for name, build in QUERIES.items():
        if not name.startswith(EAGER):
            out[name] = build(Star.of_sample(spark, SF))._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    return out


def test_no_nested_loops_and_no_python(plans):
    for name, plan in plans.items():
        for word in ("BroadcastNestedLoopJoin", "CartesianProduct", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
            assert word not in plan, (name, word)


def test_only_fixed_tables_are_broadcast(plans):
    """Without a size limit to satisfy, every broadcast left is a hint; the leaf
    below it must be a literal table (the event catalogue), never a file."""
    for name, plan in plans.items():
        lines = plan.split("\n")
        for i, line in enumerate(lines):
            if "BroadcastExchange" in line and "ReusedExchange" not in line:
                leaf = next(x for x in lines[i:] if "Scan" in x)
                assert "LocalTableScan" in leaf, (name, leaf)


def test_mart_reads_only_needed_columns(plans):
    schema = re.findall(r"ReadSchema: struct<([^>]*)>", plans["event_volume"])
    assert all("value" not in s for s in schema)


def test_error_mart_needs_no_join_with_users(plans):
    assert "SortMergeJoin" not in plans["mrt_quality"]
    assert "customer.parquet" not in plans["navigation_flow"]
