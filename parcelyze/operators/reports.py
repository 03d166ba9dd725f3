"""Dashboard data sets (tables only; rendering is out of scope)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import r2

TREND_MIN_ORDERS = 100      # a month below this is a partial / truncated month
TOP_N = 15


def monthly_trend(monthly: DataFrame, min_orders: int = TREND_MIN_ORDERS) -> DataFrame:
    """DB2 / FLT6: months with enough orders to be a full month."""
    return monthly.filter(F.col("total_orders") >= min_orders).orderBy("year_month")


def headline_kpis(monthly: DataFrame, dq_results: DataFrame,
                  min_orders: int = TREND_MIN_ORDERS) -> DataFrame:
    """DB1 / WIN4: latest full month, on-time delta vs the prior full month
    (the latest itself when alone; NULL pct counts as 0), DQ pass rate and
    flagged count. Top-2 months by a distributed take-ordered, then max_by /
    min_by over two rows -- no window."""
    last2 = (monthly.filter(F.col("total_orders") >= min_orders)
             .orderBy(F.col("year_month").desc()).limit(2))
    row = F.struct("year_month", "on_time_pct", "avg_delay_days", "total_orders", "avg_review_score")
    h = last2.agg(F.max_by(row, "year_month").alias("latest"),
                  F.min_by(row, "year_month").alias("prior"))
    dq = dq_results.select(F.struct(r2(F.lit(100.0) * F.avg("passed"), 1).alias("rate"),
                                    F.count_if(F.col("passed") == 0).alias("flagged"))).scalar()
    delta = r2(F.coalesce("latest.on_time_pct", F.lit(0.0))
                    - F.coalesce("prior.on_time_pct", F.lit(0.0)), 1)
    return h.filter(F.col("latest").isNotNull()).select(
        F.col("latest.year_month").alias("latest_month"),
        F.col("latest.on_time_pct").alias("on_time_pct"),
        delta.alias("delta_on_time_pts"),
        F.col("latest.avg_delay_days").alias("avg_delay_days"),
        F.col("latest.total_orders").alias("total_orders"),
        F.col("latest.avg_review_score").alias("avg_review_score"),
        dq.getField("rate").alias("dq_pass_rate"),
        dq.getField("flagged").alias("dq_flagged"))


def worst_sellers(scorecard: DataFrame, n: int = TOP_N) -> DataFrame:
    """DB3 / TOP1: lowest on-time % first (NULL last, as a pandas sort), ties by id."""
    return (scorecard.orderBy(F.col("on_time_pct").asc_nulls_last(), "seller_id").limit(n)
            .select("seller_id", "seller_state", "order_count", "on_time_pct",
                    "avg_delay_days", "avg_review_score"))


def worst_states(state_perf: DataFrame, n: int = TOP_N) -> DataFrame:
    """DB3 / TOP2."""
    return state_perf.orderBy(F.col("on_time_pct").asc_nulls_last(), "customer_state").limit(n)
