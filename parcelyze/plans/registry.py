"""Query registry: name -> (Spark job over the driver tables, DuckDB twin).

Each Spark callable takes (spark, sf_dir) and returns a lazy DataFrame that
reads the whole driver tables; the twin SQL (when the operator is SQL-
expressible) rebuilds the same result from the same tables in DuckDB.
"""

from __future__ import annotations

import hashlib
import threading
from functools import cached_property

from pyspark.sql import SparkSession

from ..functions.rules import r2
from ..operators import analytics as A
from ..operators import star
from ..operators.model import StarModel, TableModel
from ..session import app_id, scratch_path
from ..sources.adapter import dirty_facts, dirty_raw, raw_model
from ..sources.ingest import read_raw_layer, write_raw
from .oracle import R, with_ctes

QUERIES: dict = {}
ORACLE: dict = {}
ORACLE_BODY: dict = {}      # final SELECT of each twin, before the shared CTEs


def query(name: str, oracle: str | None = None, extra_ctes=None, recursive: bool = False):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = with_ctes(oracle, extra_ctes, recursive)
            ORACLE_BODY[name] = oracle
        return fn
    return deco


_MODELS: dict = {}
_LOCK = threading.Lock()


def model(spark: SparkSession, sf_dir: str, lazy: bool = False):
    """The raw and modeled layers for ``sf_dir``, built once per application
    (adapter -> raw layer -> star schema, each written as parquet under the
    shared checkpoint folder, as the pipeline does) and then read by every
    query. ``lazy=True`` plans from the raw driver tables instead (for plan
    inspection). The star schema is planned from the written raw layer, which
    is read as often as the seven tables need it and derived only once."""
    if lazy:
        return StarModel(raw_model(spark, sf_dir))
    key = (app_id(spark), sf_dir.rstrip("/"))
    with _LOCK:
        if key not in _MODELS:
            root = scratch_path(spark, "models", key[0],
                                hashlib.sha1(key[1].encode()).hexdigest()[:12])
            from .pipeline import write_model
            write_raw(raw_model(spark, sf_dir), f"{root}/raw")
            raw = read_raw_layer(spark, f"{root}/raw")
            write_model(StarModel(raw), f"{root}/model")
            _MODELS[key] = TableModel(spark, f"{root}/model", raw)
        return _MODELS[key]


class _DirtyModel(StarModel):
    """The star schema over the seeded raw tables, with seeded facts."""

    @cached_property
    def fact_orders(self):
        return dirty_facts(super().fact_orders)


def dirty_model(spark: SparkSession, sf_dir: str) -> StarModel:
    """A lazy model with every kind of data-quality violation in it."""
    return _DirtyModel(dirty_raw(_raw(spark, sf_dir)))


def _raw(spark, sf_dir):
    return model(spark, sf_dir).raw


# =============================================================== raw layer
@query("ingest_row_counts", """
SELECT * FROM (VALUES
  ('raw_orders', (SELECT COUNT(*) FROM raw_orders)),
  ('raw_order_items', (SELECT COUNT(*) FROM raw_order_items)),
  ('raw_order_payments', (SELECT COUNT(*) FROM raw_order_payments)),
  ('raw_order_reviews', (SELECT COUNT(*) FROM raw_order_reviews)),
  ('raw_customers', (SELECT COUNT(*) FROM raw_customers)),
  ('raw_sellers', (SELECT COUNT(*) FROM raw_sellers)),
  ('raw_products', (SELECT COUNT(*) FROM raw_products)),
  ('raw_geolocation', (SELECT COUNT(*) FROM raw_geolocation)),
  ('raw_category_translation', (SELECT COUNT(*) FROM raw_category_translation))
) AS t(table_name, row_count)""")
def q_ingest_row_counts(spark, sf_dir):
    from ..sources.ingest import row_counts
    return row_counts(_raw(spark, sf_dir))


# ============================================================= star schema
@query("dim_date", "SELECT * FROM dim_date")
def q_dim_date(spark, sf_dir):
    return model(spark, sf_dir).dim_date


@query("dim_geography", "SELECT * FROM dim_geography")
def q_dim_geography(spark, sf_dir):
    return model(spark, sf_dir).dim_geography


@query("dim_customer", "SELECT * FROM dim_customer")
def q_dim_customer(spark, sf_dir):
    return model(spark, sf_dir).dim_customer


@query("dim_seller", "SELECT * FROM dim_seller")
def q_dim_seller(spark, sf_dir):
    return model(spark, sf_dir).dim_seller


@query("dim_product", "SELECT * FROM dim_product")
def q_dim_product(spark, sf_dir):
    return model(spark, sf_dir).dim_product


@query("fact_order_items", "SELECT * FROM fact_order_items")
def q_fact_order_items(spark, sf_dir):
    return model(spark, sf_dir).fact_order_items


@query("fact_orders", "SELECT * FROM fact_orders")
def q_fact_orders(spark, sf_dir):
    from ..schemas import FACT_ORDERS_COLS
    return model(spark, sf_dir).fact_orders.select(*FACT_ORDERS_COLS)


@query("order_item_rollup", "SELECT * FROM order_item_rollup")
def q_order_item_rollup(spark, sf_dir):
    return star.order_item_rollup(_raw(spark, sf_dir)["raw_order_items"])


@query("order_payment_rollup", "SELECT * FROM order_payment_rollup")
def q_order_payment_rollup(spark, sf_dir):
    return star.order_payment_rollup(_raw(spark, sf_dir)["raw_order_payments"])


@query("order_review_rollup", "SELECT * FROM order_review_rollup")
def q_order_review_rollup(spark, sf_dir):
    return star.order_review_rollup(_raw(spark, sf_dir)["raw_order_reviews"])


@query("timestamp_anomalies", """
SELECT order_id, order_delivered_carrier_date, order_delivered_customer_date
FROM fact_orders WHERE timestamp_anomaly_flag""")
def q_timestamp_anomalies(spark, sf_dir):
    f = model(spark, sf_dir).fact_orders
    return f.filter("timestamp_anomaly_flag").select(
        "order_id", "order_delivered_carrier_date", "order_delivered_customer_date")


@query("order_stage_durations", """
SELECT order_id, processing_days, carrier_pickup_days, shipping_days,
       delivery_delay_days, on_time_flag FROM fact_orders""")
def q_order_stage_durations(spark, sf_dir):
    return model(spark, sf_dir).fact_orders.select(
        "order_id", "processing_days", "carrier_pickup_days", "shipping_days",
        "delivery_delay_days", "on_time_flag")


# =============================================================== analytics
# The twins say what a measure is (a mean of flags, a lookup of ranges, a look back
# at earlier rows); they share no clause with the operators.
_MONTHLY_SQL = f"""
SELECT year_month, count(*) AS total_orders,
       count(*) FILTER (order_status = 'delivered') AS delivered_orders,
       {R('100 * avg(on_time_flag)')} AS on_time_pct,
       {R('avg(delivery_delay_days)')} AS avg_delay_days,
       {R('avg(review_score)')} AS avg_review_score,
       sum(payment_value)::DOUBLE AS total_revenue
FROM _fym GROUP BY ALL"""


@query("monthly_kpis", _MONTHLY_SQL)
def q_monthly_kpis(spark, sf_dir):
    m = model(spark, sf_dir)
    return A.monthly_kpis(m.fact_orders, m.dim_date)


@query("seller_scorecard", f"""
WITH per_seller AS (
  SELECT seller_id, count(*) AS n, avg(on_time_flag) AS share, avg(delivery_delay_days) AS delay, avg(review_score) AS score
  FROM (FROM fact_orders WHERE n_sellers = 1) GROUP BY seller_id HAVING n >= 5)
SELECT seller_id, state AS seller_state, n AS order_count, {R('100 * share')} AS on_time_pct,
       {R('delay')} AS avg_delay_days, {R('score')} AS avg_review_score,
       rank() OVER (ORDER BY share NULLS FIRST) AS worst_on_time_rank
FROM dim_seller JOIN per_seller USING (seller_id)""")
def q_seller_scorecard(spark, sf_dir):
    m = model(spark, sf_dir)
    return A.seller_scorecard(m.fact_orders, m.dim_seller)


@query("state_performance", f"""
SELECT state AS customer_state, count(*) AS order_count, {R('100 * avg(on_time_flag)')} AS on_time_pct,
       {R('avg(delivery_delay_days)')} AS avg_delay_days, {R('avg(shipping_days)')} AS avg_shipping_days
FROM dim_customer JOIN fact_orders USING (customer_id)
GROUP BY ALL HAVING order_count >= 20""")
def q_state_performance(spark, sf_dir):
    m = model(spark, sf_dir)
    return A.state_performance(m.fact_orders, m.dim_customer)


_SELLER_MONTH_SQL = """
SELECT seller_id, year_month, count(*) AS order_count, avg(delivery_delay_days) AS avg_delay_days
FROM (FROM _fym WHERE n_sellers = 1 AND delivery_delay_days IS NOT NULL) GROUP BY ALL HAVING order_count >= 3"""


@query("seller_month_delay", f"""
SELECT seller_id, year_month, order_count, {R('avg_delay_days')} AS avg_delay_days
FROM ({_SELLER_MONTH_SQL})""")
def q_seller_month_delay(spark, sf_dir):
    m = model(spark, sf_dir)
    return A.seller_month_delay(m.fact_orders, m.dim_date).withColumn(
        "avg_delay_days", r2("avg_delay_days"))


@query("seller_month_anomalies", f"""
WITH numbered AS (
  SELECT *, row_number() OVER (PARTITION BY seller_id ORDER BY year_month) AS i FROM ({_SELLER_MONTH_SQL})),
scored AS (
  SELECT n.seller_id, n.year_month, n.order_count, n.avg_delay_days AS now,
         avg(p.avg_delay_days ORDER BY p.i) AS base
  FROM numbered n JOIN numbered p ON n.seller_id IS NOT DISTINCT FROM p.seller_id AND n.i - p.i BETWEEN 1 AND 3
  GROUP BY ALL)
SELECT seller_id, year_month, order_count, {R('now')} AS avg_delay_days, {R('base')} AS rolling_baseline_delay,
       {R('now - base')} AS delay_deviation
FROM scored WHERE now - base > 2""")
def q_seller_month_anomalies(spark, sf_dir):
    m = model(spark, sf_dir)
    return A.seller_month_anomalies(m.fact_orders, m.dim_date)


_ROOT_CAUSE_SQL = f"""
SELECT seller_id, count(*) AS order_count, {R('avg(processing_days)')} AS avg_processing_days,
       {R('avg(carrier_pickup_days)')} AS avg_carrier_pickup_days, {R('avg(shipping_days)')} AS avg_shipping_days,
       {R('avg(delivery_delay_days)')} AS avg_delay_days
FROM (FROM fact_orders WHERE n_sellers = 1) GROUP BY ALL HAVING seller_id IS NOT NULL"""


@query("root_cause_breakdown", _ROOT_CAUSE_SQL)
def q_root_cause_breakdown(spark, sf_dir):
    return A.root_cause_breakdown(model(spark, sf_dir).fact_orders)


@query("payment_vs_outcome", f"""
SELECT payment_type, coalesce(label, '7+') AS installments_bucket, count(*) AS order_count,
       {R('avg(delivery_delay_days)')} AS avg_delay_days, {R('avg(review_score)')} AS avg_review_score
FROM fact_orders LEFT JOIN (VALUES (-2147483648, 1, '1'), (2, 3, '2-3'), (4, 6, '4-6')) AS bucket(low, high, label)
  ON payment_installments BETWEEN low AND high
GROUP BY ALL HAVING payment_type IS NOT NULL""")
def q_payment_vs_outcome(spark, sf_dir):
    return A.payment_vs_outcome(model(spark, sf_dir).fact_orders)


@query("monthly_volume", "SELECT year_month, COUNT(*) AS order_count FROM _fym GROUP BY year_month")
def q_monthly_volume(spark, sf_dir):
    m = model(spark, sf_dir)
    return A.monthly_volume(m.fact_orders, m.dim_date)


@query("monthly_volume_trimmed", """
SELECT year_month, COUNT(*) AS order_count FROM _fym
WHERE year_month BETWEEN '2017-01' AND '2018-08' GROUP BY year_month""")
def q_monthly_volume_trimmed(spark, sf_dir):
    m = model(spark, sf_dir)
    return A.monthly_volume_trimmed(m.fact_orders, m.dim_date)


@query("overall_performance", f"""
SELECT COUNT(*) AS delivered_orders,
       {R('100 * avg(on_time_flag)')} AS on_time_pct,
       {R('avg(delivery_delay_days)')} AS avg_delay_days
FROM fact_orders WHERE order_status = 'delivered'""")
def q_overall_performance(spark, sf_dir):
    return A.overall_performance(model(spark, sf_dir).fact_orders)


# The other query groups register themselves on import.
from . import queries_quality, queries_stats, queries_reports  # noqa: E402,F401
