"""Plan assertions: the physical plans keep the properties the design relies on."""

import re
import tempfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from parcelyze.operators import analytics as A
from parcelyze.operators.model import TableModel
from parcelyze.plans.pipeline import write_model

from .conftest import SF001

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"]
SIDE_EFFECT = {"run_pipeline", "pipeline_run_log"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in E.queries() if n not in SIDE_EFFECT])
def test_no_cross_join_no_python(spark, name):
    plan = _plan(E.queries()[name](spark, SF001))
    bad = [k for k in FORBIDDEN if k in plan]
    assert not bad, f"{name}: {bad}"


def test_fact_build_prunes_columns_and_pre_aggregates(spark, small_model):
    plan = small_model.fact_orders._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    li = [s for s in schemas if "l_orderkey" in s]
    assert li and all("l_returnflag" not in s and "l_tax" not in s for s in li)
    # every rollup aggregates map-side before its shuffle
    assert plan.count("partial_") >= 3


def test_monthly_kpis_forces_no_broadcast(small_model):
    """A dirty date can stretch the calendar; the planner decides by its size."""
    df = A.monthly_kpis(small_model.fact_orders, small_model.dim_date)
    logical = df._jdf.queryExecution().optimizedPlan().toString()
    assert logical.count("broadcast") == 0


def test_written_fact_prunes_month_partitions(spark, small_model):
    root = tempfile.mkdtemp(prefix="pz-model-")
    write_model(small_model, root)
    f = TableModel(spark, root).fact_orders.filter(F.col("year_month") == "2017-03")
    plan = _plan(f)
    assert "PartitionFilters: [isnotnull(year_month" in plan and "2017-03" in plan
    assert f.count() == small_model.fact_orders.filter(
        F.date_format("order_purchase_timestamp", "yyyy-MM") == "2017-03").count()


def test_scorecard_rank_has_no_global_window(spark, small_model):
    # the only unpartitioned window allowed is over the (<= buckets) bucket totals
    df = A.seller_scorecard(small_model.fact_orders, small_model.dim_seller)
    plan = _plan(df)
    windows = re.findall(r"Window \[[^\n]*", plan)
    assert len(windows) == 2                   # running sums within buckets + bucket offsets
    # "Window [fns], [partition], [order]" vs "Window [fns], [order]" (unpartitioned)
    unpartitioned = [w for w in windows if w.count("], [") == 1]
    assert len(unpartitioned) == 1 and "_bn" in unpartitioned[0]


def test_month_filter_prunes_written_fact(spark):
    from parcelyze.plans.registry import model
    m = model(spark, SF001)
    df = A.monthly_volume_trimmed(m.fact_orders, m.dim_date, "2018-01", "2018-03")
    plan = _plan(df)
    assert re.search(r"PartitionFilters: \[[^\]]*year_month[^\]]*2018-01", plan)
    assert sorted(r["year_month"] for r in df.collect()) == ["2018-01", "2018-02", "2018-03"]
