"""
product, no nested-loop join, no Python UDF; parquet scans prune columns."""

import re

import pytest

from tidemark import plans

from conftest import SF

QUERIES = plans.queries()
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_shape(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"


def test_scans_prune_columns(spark):
    plan = QUERIES["rec3_cell_diff"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    cols = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    assert cols and all(len(c.split(",")) < 11 for c in cols)  # lineitem has 11 columns


@pytest.mark.parametrize(("name", "most"), [("met3_percent_cover", 1), ("met6_size_stats", 1), ("met9_pivot_density", 1), ("rec1_missing_keys", 1), ("met16_assemble_margin", 12)])
def test_exchanges_without_broadcast(spark, name, most):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(re.findall(r"(?<!Reused)Exchange (?:hash|range)partitioning", plan)) <= most
