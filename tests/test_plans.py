"""Plan guards: every registered query keeps the shape the scale design relies on."""

import pytest

from inforce.plans import QUERIES

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "PythonUDF")


@pytest.fixture(scope="module")
def plans(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # the plan a large input gets
    try:
        yield {n: f(spark, SF)._jdf.queryExecution().executedPlan().toString() for n, f in QUERIES.items()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_cartesian_nested_loop_or_python(plans):
    bad = {n: [k for k in FORBIDDEN if k in p] for n, p in plans.items()}
    assert {n: v for n, v in bad.items() if v} == {}


def test_scans_are_pruned_and_filtered(plans):
    # the flagship reads 6 of lineitem's 11 columns and pushes the coverage filter into the scan
    p = plans["w12_running_ratio"]
    assert "PushedFilters: [IsNotNull(l_returnflag), Not(EqualTo(l_returnflag,R))" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_discount:double,l_tax:double,l_returnflag" in p
    scan = [line for line in p.split("\n") if "FileScan parquet" in line and "lineitem.parquet" in line]
    assert scan and all("l_partkey" not in line and "l_quantity" not in line for line in scan)


def test_top_one_per_key_uses_a_partial_group_limit(plans):
    assert "WindowGroupLimit" in plans["w01_latest_term"]
