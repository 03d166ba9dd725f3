"""The six operational SQL questions plus the volume series, as DataFrame
functions over the star schema (fact_orders + dimensions).

Skew handling: per-seller and per-customer measures are first reduced to
sums and counts per key with map-side partial aggregation, *then* joined to
the dimension and finished. A seller holding a third of all orders costs one
pre-aggregated row per map task, and the dimension join is one-to-one on
already-aggregated rows. Averages are carried as (sum, count) so the re-grouping
is exact, even if a dimension repeats a key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import count_true, guarded_pct, installment_bucket, r2
from ..session import merged
from .model import with_year_month
from .ranking import global_rank

# ------------------------------------------------------------ partial sums
_AVG_COLS = ["delivery_delay_days", "review_score", "shipping_days",
             "processing_days", "carrier_pickup_days"]


def _partials(cols=_AVG_COLS):
    """Aggregates that can be summed again after a join: counts and sums."""
    aggs = [F.count(F.lit(1)).alias("_rows"),
            count_true(F.col("on_time_flag") == 1).alias("_ontime"),
            F.count("on_time_flag").alias("_sla")]
    for c in cols:
        aggs += [F.sum(c).alias(f"_s_{c}"), F.count(c).alias(f"_n_{c}")]
    return aggs


def _resum(cols=_AVG_COLS):
    aggs = [F.sum("_rows").alias("_rows"), F.sum("_ontime").alias("_ontime"),
            F.sum("_sla").alias("_sla")]
    for c in cols:
        aggs += [F.sum(f"_s_{c}").alias(f"_s_{c}"), F.sum(f"_n_{c}").alias(f"_n_{c}")]
    return aggs


def _avg(c: str):
    return F.try_divide(F.col(f"_s_{c}"), F.col(f"_n_{c}"))


def _pct(decimals=2):
    return guarded_pct(F.col("_ontime"), F.col("_sla"), decimals)


# ------------------------------------------------------------------- 01 KPIs
def monthly_kpis(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """AGG7: per purchase month -- orders, delivered, on-time %, avg delay,
    avg review, revenue."""
    f = with_year_month(fact, dim_date)
    on_time, sla = count_true(F.col("on_time_flag") == 1), F.count("on_time_flag")
    return (f.groupBy("year_month")
            .agg(F.count(F.lit(1)).alias("total_orders"),
                 count_true(F.col("order_status") == "delivered").alias("delivered_orders"),
                 guarded_pct(on_time, sla).alias("on_time_pct"),
                 r2(F.avg("delivery_delay_days")).alias("avg_delay_days"),
                 r2(F.avg("review_score")).alias("avg_review_score"),
                 F.round(F.sum("payment_value"), 2).cast("double").alias("total_revenue"))
            .orderBy("year_month"))


# ------------------------------------------------------- 02 seller scorecard
def seller_measures(fact: DataFrame, dim_seller: DataFrame, min_orders: int = 5) -> DataFrame:
    """AGG8: single-seller orders per seller, HAVING >= min_orders, with the
    unrounded on-time ratio as ``_ratio``. Lazy."""
    per_seller = (fact.filter(F.col("n_sellers") == 1)
                  .groupBy("seller_id").agg(*_partials()))
    s = (per_seller.join(merged(dim_seller.select("seller_id", F.col("state").alias("seller_state"))),
                         "seller_id", "inner")
         .groupBy("seller_id", "seller_state").agg(*_resum())
         .filter(F.col("_rows") >= min_orders))
    ratio = _pct(None)
    return s.select("seller_id", "seller_state", F.col("_rows").alias("order_count"),
                    r2(ratio).alias("on_time_pct"),
                    r2(_avg("delivery_delay_days")).alias("avg_delay_days"),
                    r2(_avg("review_score")).alias("avg_review_score"), ratio.alias("_ratio"))


def seller_scorecard(fact: DataFrame, dim_seller: DataFrame, min_orders: int = 5) -> DataFrame:
    """AGG8 + WIN1: the measures ranked by the unrounded on-time ratio ascending
    (NULL first = worst). The rank runs a job that writes the per-seller rows."""
    s = global_rank(seller_measures(fact, dim_seller, min_orders), "_ratio", "worst_on_time_rank")
    return s.drop("_ratio").orderBy(F.col("on_time_pct").asc_nulls_first(), "seller_id")


# ------------------------------------------------------ 03 state performance
def state_performance(fact: DataFrame, dim_customer: DataFrame, min_orders: int = 20) -> DataFrame:
    """AGG9: per customer state, HAVING >= min_orders; pre-aggregated per
    customer before the (one-to-one) customer join."""
    per_cust = fact.groupBy("customer_id").agg(*_partials())
    s = (per_cust.join(merged(dim_customer.select("customer_id", F.col("state").alias("customer_state"))),
                       "customer_id", "inner")
         .groupBy("customer_state").agg(*_resum())
         .filter(F.col("_rows") >= min_orders))
    return (s.select("customer_state",
                     F.col("_rows").alias("order_count"),
                     _pct().alias("on_time_pct"),
                     r2(_avg("delivery_delay_days")).alias("avg_delay_days"),
                     r2(_avg("shipping_days")).alias("avg_shipping_days"))
            .orderBy(F.col("on_time_pct").asc_nulls_first(), "customer_state"))


# ------------------------------------------------ 04 rolling-baseline anomaly
def seller_month_delay(fact: DataFrame, dim_date: DataFrame, min_orders: int = 3) -> DataFrame:
    """AGG10: single-seller orders with a delay, per (seller, month), HAVING >= 3.
    Unrounded average; callers round."""
    f = with_year_month(fact.filter((F.col("n_sellers") == 1)
                                    & F.col("delivery_delay_days").isNotNull()), dim_date)
    return (f.groupBy("seller_id", "year_month")
            .agg(F.count(F.lit(1)).alias("order_count"),
                 F.avg("delivery_delay_days").alias("avg_delay_days"))
            .filter(F.col("order_count") >= min_orders))


def seller_month_anomalies(fact: DataFrame, dim_date: DataFrame, min_orders: int = 3,
                           threshold: float = 2.0, window_rows: int = 3) -> DataFrame:
    """WIN2/WIN3: month average vs. the mean of the seller's previous
    ``window_rows`` qualifying months (rows, so gaps are skipped); keep
    deviations > threshold. The window is partitioned by seller and holds one
    row per month, so a hot seller adds months, not orders, to its task."""
    from pyspark.sql import Window
    sm = seller_month_delay(fact, dim_date, min_orders)
    w = Window.partitionBy("seller_id").orderBy("year_month").rowsBetween(-window_rows, -1)
    b = sm.withColumn("_base", F.avg("avg_delay_days").over(w))
    dev = F.col("avg_delay_days") - F.col("_base")
    return (b.filter(F.col("_base").isNotNull() & (dev > threshold))
            .select("seller_id", "year_month", "order_count",
                    r2("avg_delay_days").alias("avg_delay_days"),
                    r2("_base").alias("rolling_baseline_delay"),
                    r2(dev).alias("delay_deviation"))
            .orderBy(F.col("delay_deviation").desc(), "seller_id", "year_month"))


# --------------------------------------------------- 05 root-cause breakdown
def root_cause_breakdown(fact: DataFrame, seller_ids=None) -> DataFrame:
    """AGG11 / FLT3: stage averages per seller over single-seller orders.

    ``seller_ids``: None = every seller; a string = one seller (the bound
    parameter form); a DataFrame with a seller_id column = those sellers, joined
    to the aggregated rows (one per seller) and keeping the columns it brings
    (one job for all flagged sellers instead of one query per seller)."""
    f = fact.filter((F.col("n_sellers") == 1) & F.col("seller_id").isNotNull())
    if isinstance(seller_ids, str):
        f = f.filter(F.col("seller_id") == F.lit(seller_ids))
    per = f.groupBy("seller_id").agg(
        F.count(F.lit(1)).alias("order_count"),
        r2(F.avg("processing_days")).alias("avg_processing_days"),
        r2(F.avg("carrier_pickup_days")).alias("avg_carrier_pickup_days"),
        r2(F.avg("shipping_days")).alias("avg_shipping_days"),
        r2(F.avg("delivery_delay_days")).alias("avg_delay_days"))
    if seller_ids is None or isinstance(seller_ids, str):
        return per
    brought = [c for c in seller_ids.columns if c not in per.columns]
    return per.join(merged(seller_ids.select("seller_id", *brought)), "seller_id")


# ------------------------------------------------------- 06 payment vs outcome
def payment_vs_outcome(fact: DataFrame) -> DataFrame:
    """AGG12 / PRJ15: payment type x installment bucket."""
    return (fact.filter(F.col("payment_type").isNotNull())
            .groupBy("payment_type",
                     installment_bucket("payment_installments").alias("installments_bucket"))
            .agg(F.count(F.lit(1)).alias("order_count"),
                 r2(F.avg("delivery_delay_days")).alias("avg_delay_days"),
                 r2(F.avg("review_score")).alias("avg_review_score"))
            .orderBy(F.col("order_count").desc(), "payment_type", "installments_bucket"))


# ------------------------------------------------------------ volume series
def monthly_volume(fact: DataFrame, dim_date: DataFrame, keys=()) -> DataFrame:
    """AGG13: orders per purchase month (optionally per extra key columns)."""
    return (with_year_month(fact, dim_date).groupBy(*keys, "year_month")
            .agg(F.count(F.lit(1)).alias("order_count")))


def monthly_volume_trimmed(fact: DataFrame, dim_date: DataFrame, start: str = "2017-01",
                           end: str = "2018-08", keys=()) -> DataFrame:
    """FLT5: inclusive month window (drops ramp-up and truncated tail months)."""
    return monthly_volume(fact, dim_date, keys).filter(F.col("year_month").between(start, end))


def overall_performance(fact: DataFrame) -> DataFrame:
    """AGG14 / FLT7: delivered orders, on-time % (mean of the flag), mean delay."""
    d = fact.filter(F.col("order_status") == "delivered")
    return d.agg(F.count(F.lit(1)).alias("delivered_orders"),
                 r2(F.lit(100.0) * F.avg("on_time_flag")).alias("on_time_pct"),
                 r2(F.avg("delivery_delay_days")).alias("avg_delay_days"))
