"""Plans: what reaches the scan, and what must not be in a plan."""

import pytest

from larkspur import Context, col
from larkspur.plans import catalog

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lineitem(spark):
    return Context(spark).read_parquet(f"{SF}/lineitem.parquet")


def test_pushdown_and_pruning(lineitem):
    p = plan(lineitem.filter(col("l_quantity") > 10).group_by("l_returnflag").agg(col("l_tax").sum()).to_df())
    assert "GreaterThan(l_quantity" in p
    assert "ReadSchema: struct<l_quantity:double,l_tax:double,l_returnflag:string>" in p
    assert "_metadata" not in p and p.count("Exchange") == 1 and p.count("HashAggregate") == 2


def test_top_k(lineitem):
    p = plan(lineitem.sort("l_extendedprice", descending=True).head(5).to_df())
    assert "TakeOrderedAndProject" in p and "rangepartitioning" not in p


def test_no_python_in_any_plan(spark):
    for name, build in catalog.queries().items():
        p = plan(build(spark, SF))
        assert "Python" not in p and "Pandas" not in p and "CartesianProduct" not in p, name


def test_no_window_over_one_partition(spark):
    for name, build in catalog.queries().items():
        p = plan(build(spark, SF))
        assert "Window [" not in p or "SinglePartition" not in p.split("Window [")[1].split("Exchange")[0], name
    ordered = Context(spark).read_parquet(f"{SF}/events.parquet").sort("ts", "event_type", "value", descending=True)
    assert "Window" not in plan(ordered.group_by("user_id").agg(col("event_id").first()).to_df())


def test_every_query_has_sql():
    assert catalog.queries().keys() == catalog.oracle_sql().keys()
