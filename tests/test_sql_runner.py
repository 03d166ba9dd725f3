"""The SQL-file runner agrees with the DataFrame operators."""

from parcelyze.operators import analytics as A
from parcelyze.plans.sql_runner import run_all, run_query


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_sql_files_match_dataframe_functions(spark, small_model):
    m = small_model
    sql = run_all(spark, m)
    assert _rows(sql["monthly_kpis"]) == _rows(A.monthly_kpis(m.fact_orders, m.dim_date))
    assert _rows(sql["seller_scorecard"]) == _rows(A.seller_scorecard(m.fact_orders, m.dim_seller))
    assert _rows(sql["state_performance"]) == _rows(A.state_performance(m.fact_orders, m.dim_customer))
    assert _rows(sql["seller_month_anomalies"]) == _rows(A.seller_month_anomalies(m.fact_orders, m.dim_date))
    assert _rows(sql["payment_vs_outcome"]) == _rows(A.payment_vs_outcome(m.fact_orders))


def test_bound_seller_parameter(spark, small_model):
    m = small_model
    sid = A.seller_scorecard(m.fact_orders, m.dim_seller).first()["seller_id"]
    got = _rows(run_query(spark, m, "root_cause_breakdown", {"seller_id": sid}))
    assert len(got) == 1 and got == _rows(A.root_cause_breakdown(m.fact_orders, sid))
    assert run_query(spark, m, "root_cause_breakdown", {"seller_id": "nobody"}).count() == 0
    low = run_query(spark, m, "seller_scorecard", {"min_orders": 1}).count()
    assert low >= run_query(spark, m, "seller_scorecard").count()
