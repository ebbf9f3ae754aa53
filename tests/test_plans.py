"""Physical-plan guards: the scale properties the design relies on."""

import re

import pytest

import __spark_entry__ as E
from vitrine.plans.queries import REGISTRY

from .conftest import SF


def _plan(spark, df):
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_no_cartesian_products(spark, name):
    if name in ("csv_ingest",):  # writes files while building the frame
        pytest.skip("side-effecting query")
    plan = _plan(spark, E.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan
    # Nested-loop joins only against the fixed-size rule table or broadcast probe lists.
    for m in re.finditer(r"\(\d+\) BroadcastNestedLoopJoin.*?Join condition: ([^\n]*)", plan, re.S):
        cond = m.group(1)
        assert "rule_key" in cond or "Contains" in cond, cond


@pytest.mark.parametrize("name", ["knn_by_product", "dup_pairs_chain", "text_search", "recommend_all"])
def test_scans_are_pruned(spark, name):
    plan = _plan(spark, E.queries()[name](spark, SF))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas
    for s in schemas:
        assert "p_retailprice" not in s or "p_name" not in s or len(s.split(",")) < 6, s
