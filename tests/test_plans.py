"""Plan-level guards for every registered report: no cross products, no
nested-loop joins, no row-at-a-time Python UDFs, and pruned Parquet scans."""

import re

import pytest

import __spark_entry__ as entry
from tessera.plans import REPORTS

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")
# reports whose features are computed from the document text itself
NEEDS_TEXT = {"logistic_weights", "logistic_predict", "logistic_loss"}


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_plan_shape(spark, name):
    df = entry.queries()[name](spark, SF)
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan):
        assert name in NEEDS_TEXT or "text:string" not in schema, f"{name} reads text: {schema}"
