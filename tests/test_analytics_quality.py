"""SQL analytics and data-quality checks: reference tests plus trap fixtures."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from parcelyze.operators import analytics as A
from parcelyze.operators import quality as Q
from parcelyze.operators import reports as P
from parcelyze.operators.model import StarModel
from parcelyze.operators.ranking import global_rank

from .fixtures import money, order, raw_frames, ts


def test_monthly_kpis_pct_bounds(small_model):
    rows = A.monthly_kpis(small_model.fact_orders, small_model.dim_date).collect()
    assert rows and all(r["on_time_pct"] is None or 0 <= r["on_time_pct"] <= 100 for r in rows)
    assert [r["year_month"] for r in rows] == sorted(r["year_month"] for r in rows)


def test_scorecard_min_orders_and_rank(small_model):
    sc = A.seller_scorecard(small_model.fact_orders, small_model.dim_seller).collect()
    assert len(sc) == 10 and all(r["order_count"] >= 5 for r in sc)
    # rank is RANK() over the unrounded ratio: 1 for the worst, ties share
    worst = min(sc, key=lambda r: r["worst_on_time_rank"])
    assert worst["worst_on_time_rank"] == 1
    assert worst["on_time_pct"] == min(r["on_time_pct"] for r in sc)


def test_state_performance_sorted(small_model):
    rows = A.state_performance(small_model.fact_orders, small_model.dim_customer, 20).collect()
    vals = [r["on_time_pct"] for r in rows if r["on_time_pct"] is not None]
    assert vals == sorted(vals)


def test_root_cause_single_seller(small_model):
    f = small_model.fact_orders
    sid = A.seller_scorecard(f, small_model.dim_seller).first()["seller_id"]
    rows = A.root_cause_breakdown(f, sid).collect()
    assert len(rows) == 1 and rows[0]["order_count"] >= 5
    assert A.root_cause_breakdown(f, "no-such-seller").count() == 0


def test_seller_without_sla_ranks_first(spark):
    # T10 / T22: COUNT(*) counts every status; a seller with no SLA outcome
    # has a NULL ratio and takes rank 1.
    d = ts("2018-01-01 00:00:00")
    orders = [order(f"o{i}", status="shipped", delivered=None) for i in range(5)] + \
             [order(f"p{i}") for i in range(5)]
    items = [(f"o{i}", 1, "p", "s_open", d, money(1), money(1)) for i in range(5)] + \
            [(f"p{i}", 1, "p", "s_good", d, money(1), money(1)) for i in range(5)]
    raw = raw_frames(spark, raw_orders=orders, raw_order_items=items,
                     raw_sellers=[("s_open", 1, "x", "SP"), ("s_good", 2, "y", "RJ")])
    m = StarModel(raw)
    r = {x["seller_id"]: x for x in A.seller_scorecard(m.fact_orders, m.dim_seller).collect()}
    assert r["s_open"]["on_time_pct"] is None and r["s_open"]["worst_on_time_rank"] == 1
    assert r["s_good"]["on_time_pct"] == 100.0 and r["s_good"]["worst_on_time_rank"] == 2
    w = P.worst_sellers(A.seller_scorecard(m.fact_orders, m.dim_seller)).collect()
    assert w[-1]["seller_id"] == "s_open"          # pandas-style sort: NULL last


def test_installment_bucket_null_is_7plus(spark):
    raw = raw_frames(spark, raw_orders=[order("a"), order("b")],
                     raw_order_payments=[("a", 1, "boleto", None, money(1)),
                                         ("b", 1, "boleto", 1, money(1))])
    rows = {r["installments_bucket"]: r["order_count"]
            for r in A.payment_vs_outcome(StarModel(raw).fact_orders).collect()}
    assert rows == {"7+": 1, "1": 1}


def test_rolling_baseline_skips_gaps(spark):
    # T15: the baseline is the previous 3 qualifying ROWS, not calendar months.
    d = ts("2018-01-01 00:00:00")
    months = {"2018-01": 0, "2018-02": 0, "2018-04": 0, "2018-07": 5}
    orders, items = [], []
    for m, late in months.items():
        for i in range(3):
            oid = f"{m}-{i}"
            orders.append(order(oid, purchase=f"{m}-01 00:00:00", approved=f"{m}-01 00:00:00",
                                carrier=f"{m}-02 00:00:00", delivered=f"{m}-{10 + late:02d} 00:00:00",
                                estimated=f"{m}-10 00:00:00"))
            items.append((oid, 1, "p", "s1", d, money(1), money(1)))
    m = StarModel(raw_frames(spark, raw_orders=orders, raw_order_items=items))
    rows = A.seller_month_anomalies(m.fact_orders, m.dim_date).collect()
    assert [(r["year_month"], r["rolling_baseline_delay"], r["delay_deviation"]) for r in rows] == \
        [("2018-07", 0.0, 5.0)]


def test_global_rank_matches_window_rank(spark):
    import random
    rnd = random.Random(7)
    data = [(i, rnd.choice([None, 1.0, 2.5, 2.5, 3.0, 100.0, rnd.random()])) for i in range(400)]
    df = spark.createDataFrame(data, "id int, v double")
    got = {r["id"]: r["rk"] for r in global_rank(df, "v", "rk", buckets=8).collect()}
    want = {r["id"]: r["rk"] for r in
            df.withColumn("rk", F.rank().over(Window.orderBy(F.col("v").asc_nulls_first()))).collect()}
    assert got == want


# ------------------------------------------------------------- quality
def test_raw_checks_shape_and_known_flags(small_model):
    df = Q.raw_checks(small_model.raw, "2018-09-01T00:00:00+00:00").collect()
    assert len(df) == 12
    flagged = {r["check_id"] for r in df if r["passed"] == 0}
    assert flagged == {3, 8, 9, 11}                  # FIXTURES.md: DQ3, DQ8, DQ9, DQ11
    by = {r["check_id"]: r for r in df}
    assert by[8]["violations"] == 15 and by[9]["violations"] == 27 and by[11]["violations"] == 8
    assert by[8]["detail"] == ("15 orders where customer delivery is before carrier handoff "
                               "(bad timestamps)")
    assert by[10]["detail"] == "all statuses known"
    assert by[12]["detail"] == "pipeline executed at 2018-09-01T00:00:00+00:00"


def test_modeled_checks_all_pass(small_model):
    rows = Q.modeled_checks(small_model, small_model.raw["raw_orders"], "t").collect()
    assert len(rows) == 7 and all(r["passed"] == 1 for r in rows)
    by = {r["check_id"]: r["detail"] for r in rows}
    assert by[6] == "raw_orders=1,500 vs fact_orders=1,500"
    assert by[7] == "94.5% of orders have a computable SLA delay (1,417/1,500)"


def test_raw_checks_on_dirty_fixture(spark):
    d = ts("2018-01-01 00:00:00")
    raw = raw_frames(
        spark,
        raw_orders=[order("a"), order("a"), order(None), order("w", status="weird"),
                    order("n", status=None), order("x", customer="ghost")],
        raw_order_items=[("a", 1, "p", "s", d, money(-1), money(0)), ("zz", 1, "p", "s", d, money(1), money(1))],
        raw_order_reviews=[("a", 0), ("a", 6), ("a", None), ("a", 5)],
        raw_customers=[("c1", "u", 1, "x", "SP")])
    by = {r["check_id"]: r for r in Q.raw_checks(raw, "t").collect()}
    assert by[1]["violations"] == 1 and by[2]["violations"] == 1
    assert by[4]["violations"] == 1 and by[5]["violations"] == 2
    assert by[6]["violations"] == 1 and by[7]["violations"] == 1
    assert by[10]["passed"] == 0 and by[10]["violations"] == 2
    assert by[10]["detail"].startswith("unexpected status values: 2 ")       # each is a row of unexpected_values()


def test_dq_report_and_health(small_model):
    res = Q.raw_checks(small_model.raw, "t").unionByName(
        Q.modeled_checks(small_model, small_model.raw["raw_orders"], "t"))
    h = Q.dq_health(res).first()
    assert (h["n_passed"], h["n_flagged"], h["n_checks"]) == (15, 4, 19)
    assert h["pass_rate"] == 78.9
    rep = Q.dq_report(res).collect()
    assert {r["passed"] for r in rep} == {"Yes", "Flagged"}


def test_violating_rows_drilldown(small_model):
    raw = small_model.raw
    assert Q.orphan_rows(raw["raw_order_items"], "order_id", raw["raw_orders"], "order_id").count() == 0


@pytest.mark.parametrize("layer", ["raw"])
def test_unexpected_values_counts_nulls(spark, layer):
    df = spark.createDataFrame([("delivered",), (None,), ("odd",), ("odd",)], "order_status string")
    got = {r["order_status"]: r["row_count"] for r in
           Q.unexpected_values(df, "order_status", ["delivered"]).collect()}
    assert got == {None: 1, "odd": 2}


def test_violating_rows_match_counts(small_model):
    raw = small_model.raw
    res = {r["check_id"]: r["violations"] for r in Q.raw_checks(raw, "t").collect()}
    for cid in (1, 2, 3, 4, 5, 6, 7, 8, 9, 11):
        assert Q.violating_rows("raw", cid, raw=raw).count() == res[cid], cid
    mres = {r["check_id"]: r["violations"] for r in
            Q.modeled_checks(small_model, raw["raw_orders"], "t").collect()}
    for cid in (1, 2, 3, 4, 5):
        assert Q.violating_rows("modeled", cid, model=small_model).count() == mres[cid], cid
    with pytest.raises(ValueError):
        Q.violating_rows("raw", 12, raw=raw)
