import re

import pytest

from perigee.operators import distributed
from perigee.plans import evaluation, population, profiling
from perigee.plans.registry import table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("build", [evaluation.pr_curve, evaluation.pr_auc, evaluation.roc_auc, evaluation.best_threshold])
def test_curves_have_no_global_window(spark, sf, monkeypatch, build):
    monkeypatch.setattr(distributed, "BUCKET_ROWS", 100)  # as if the scores were many
    text = plan(build(spark, sf))
    # A window without a partition key would pull every row into one task.
    for spec in re.findall(r"windowspecdefinition\(([^)]*)", text):
        assert not re.match(r"\S+ (ASC|DESC)", spec)


@pytest.mark.parametrize("build", [
    population.stage_clean, population.capped_population, population.names_dim, population.full_records,
    profiling.histogram, profiling.histogram_by_class,
])
def test_no_cross_joins(spark, sf, build):
    text = plan(build(spark, sf))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_pushdown_and_pruning(spark, sf):
    text = plan(table(spark, sf, "orders").filter("o_totalprice > 300000").select("o_custkey"))
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice" in text
    scan = plan(population.names_dim(spark, sf))
    # Customers, the mart's columns of orders, and the keys of orders. All else stays unread.
    scans = re.findall(r"PushedFilters: \[([^\]]*)\], ReadSchema: struct<([^>\n]*)", scan)
    assert ("IsNotNull(c_custkey)", "c_custkey:bigint,c_name:string,c_mktsegment:string") in scans
    assert ("IsNotNull(o_orderkey), IsNotNull(o_custkey)", "o_orderkey:bigint,o_custkey:bigint") in scans
    # The plan's text cuts the mart's columns off; no further scan is there.
    mart = [s for s in re.findall(r"ReadSchema: struct<([^\n]*)", scan) if s.startswith("o_orderkey:bigint,o_custkey:bigint,")]
    assert len(mart) == 1 and len(re.findall("ReadSchema", scan)) == 3 and "comment" not in scan.lower()
