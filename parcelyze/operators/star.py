"""Star schema: 5 dimensions and 2 facts built from the raw layer.

Plan shape (what matters at scale):
* Every per-order rollup is a two-level hash aggregate with map-side partial
  aggregation: level 1 on (order_id, value) pre-combines inside each map task,
  level 2 on order_id. A hot order or seller therefore never ships its raw rows
  to one task; only one pre-aggregated row per map task and value.
* The three rollups come out hash-partitioned on order_id, so the three left
  joins to orders are sort-merge joins that reuse that partitioning.
* Modal values ("most frequent, first seen wins") are min(struct(-count,
  first position, value)) -- partial-aggregatable, deterministic, no window.
* First-row dedup is min(struct(ordering...)) per key, for the same reason.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import days_between, is_valid_delivery
from ..schemas import FACT_ORDERS_COLS
from ..session import merged


# ---------------------------------------------------------------- dimensions
def dim_date(raw_orders: DataFrame) -> DataFrame:
    """Contiguous calendar from the first to the last purchase day (GEN1, AGG6).

    The bounds are one aggregated row; the day sequence is bounded by the
    calendar span (not by data volume), so exploding it in one row is safe."""
    bounds = raw_orders.agg(F.min(F.to_date("order_purchase_timestamp")).alias("lo"),
                            F.max(F.to_date("order_purchase_timestamp")).alias("hi"))
    d = bounds.filter(F.col("lo").isNotNull()).select(
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    return d.select(
        F.date_format("full_date", "yyyyMMdd").cast("int").alias("date_key"),
        "full_date",
        F.year("full_date").alias("year"),
        F.month("full_date").alias("month"),
        F.quarter("full_date").alias("quarter"),
        F.date_format("full_date", "EEEE").alias("day_of_week"),
        (F.weekday("full_date") >= 5).alias("is_weekend"),
        F.date_format("full_date", "yyyy-MM").alias("year_month"),
    )


def dim_geography(raw_geolocation: DataFrame, approx: bool = False) -> DataFrame:
    """One row per zip prefix: median lat/lng, modal city/state (smallest on ties).

    Exact medians use grouped_exact_quantiles (two small jobs run when this is
    called): a zip holding a third of all geocodes is spread over value buckets
    instead of one in-memory value map in one task. Modes are two-level counts
    with min(struct), like the other modal values. ``approx=True`` uses a fixed-size quantile sketch per zip instead."""
    from .ranking import grouped_exact_quantiles
    g = raw_geolocation.filter(F.col("geolocation_zip_code_prefix").isNotNull()) \
        .withColumnRenamed("geolocation_zip_code_prefix", "zip_prefix")
    modes = g.select("zip_prefix").distinct()
    for col, name in (("geolocation_city", "city"), ("geolocation_state", "state")):
        counted = g.filter(F.col(col).isNotNull()).groupBy("zip_prefix", F.col(col).alias("_v")).agg(
            F.count(F.lit(1)).alias("_n"))
        best = counted.groupBy("zip_prefix").agg(F.min(F.struct((-F.col("_n")).alias("n"), "_v")).alias("_m"))
        modes = modes.join(merged(best.select("zip_prefix", F.col("_m._v").alias(name))), "zip_prefix", "left")
    if approx:
        med = g.groupBy("zip_prefix").agg(
            F.percentile_approx("geolocation_lat", 0.5, 10000).cast("double").alias("lat"),
            F.percentile_approx("geolocation_lng", 0.5, 10000).cast("double").alias("lng"))
    else:
        lat = grouped_exact_quantiles(g, ["zip_prefix"], "geolocation_lat", [0.5]) \
            .withColumnRenamed("q0", "lat")
        lng = grouped_exact_quantiles(g, ["zip_prefix"], "geolocation_lng", [0.5]) \
            .withColumnRenamed("q0", "lng")
        med = lat.join(merged(lng), "zip_prefix", "full_outer")
    # every zip has a mode row; a zip whose coordinates are all NULL gets NULL medians
    return modes.join(merged(med), "zip_prefix", "left").select("zip_prefix", "lat", "lng", "city", "state")


def dim_customer(raw_customers: DataFrame) -> DataFrame:
    return raw_customers.select(
        "customer_id", "customer_unique_id",
        F.col("customer_zip_code_prefix").alias("zip_prefix"),
        F.col("customer_city").alias("city"),
        F.col("customer_state").alias("state"))


def dim_seller(raw_sellers: DataFrame) -> DataFrame:
    return raw_sellers.select(
        "seller_id",
        F.col("seller_zip_code_prefix").alias("zip_prefix"),
        F.col("seller_city").alias("city"),
        F.col("seller_state").alias("state"))


def dim_product(raw_products: DataFrame, raw_translation: DataFrame) -> DataFrame:
    """Category fallback English -> original -> 'unknown' (PRJ13).

    The lookup join is null-safe (a NULL category matches a NULL translation
    key, as a pandas merge does). The translation side is tiny but its size is
    left to Spark's planner (broadcast when the measured size allows)."""
    t = raw_translation.select(F.col("product_category_name").alias("_cat"),
                               "product_category_name_english")
    p = raw_products.join(t, raw_products.product_category_name.eqNullSafe(t._cat), "left")
    return p.select(
        "product_id",
        F.coalesce("product_category_name_english", "product_category_name",
                   F.lit("unknown")).alias("category"),
        "product_weight_g", "product_length_cm", "product_height_cm",
        "product_width_cm", "product_photos_qty")


# --------------------------------------------------------------------- facts
ITEM_ORDER = ["shipping_limit_date", "product_id", "seller_id", "price", "freight_value"]
SEQ = "_seq"        # ingest sequence (file order), present when the raw layer came from files


def _first_order(df: DataFrame, fallback) -> list:
    """Columns that define "first": file order when an ingest sequence exists,
    else a deterministic total order of the given columns."""
    return [SEQ, *fallback] if SEQ in df.columns else list(fallback)


def fact_order_items(raw_items: DataFrame) -> DataFrame:
    """One row per (order_id, item_number): the first row (file order when the
    ingest sequence is known, else a total order of the remaining columns)
    (DED1), via a partial-aggregatable min(struct)."""
    first = raw_items.groupBy("order_id", F.col("order_item_id").alias("item_number")).agg(
        F.min(F.struct(*_first_order(raw_items, ITEM_ORDER))).alias("r"))
    return first.select(
        F.concat("order_id", F.lit("-"), F.col("item_number").cast("string")).alias("order_item_id"),
        "order_id", "item_number",
        *[F.col(f"r.{c}").alias(c) for c in ["product_id", "seller_id", "price",
                                               "freight_value", "shipping_limit_date"]])


def _modal(value: str, count: str, first_pos: str):
    """Most frequent non-NULL value, ties -> earliest first position, then value."""
    return F.min(F.when(F.col(value).isNotNull(),
                        F.struct((-F.col(count)).alias("k"), F.col(first_pos).alias("p"),
                                 F.col(value).alias("v")))).getField("v")


def order_item_rollup(raw_items: DataFrame) -> DataFrame:
    """AGG1 over RAW items (duplicates included): item_count, totals (0 when all
    NULL), distinct sellers and the primary (modal) seller; ties go to the
    seller seen first (file order when known, else the lowest line number)."""
    pos = SEQ if SEQ in raw_items.columns else "order_item_id"
    l1 = (raw_items.filter(F.col("order_id").isNotNull())
          .groupBy("order_id", "seller_id")
          .agg(F.count("order_item_id").alias("n_items"),
               F.count(F.lit(1)).alias("n_rows"),
               F.min(pos).alias("first_pos"),
               F.sum("price").alias("s_price"),
               F.sum("freight_value").alias("s_freight")))
    return l1.groupBy("order_id").agg(
        F.sum("n_items").alias("item_count"),
        F.coalesce(F.sum("s_price"), F.lit(0)).cast("decimal(18,2)").alias("total_price"),
        F.coalesce(F.sum("s_freight"), F.lit(0)).cast("decimal(18,2)").alias("total_freight"),
        F.count("seller_id").alias("n_sellers"),
        _modal("seller_id", "n_rows", "first_pos").alias("primary_seller_id"))


def order_payment_rollup(raw_payments: DataFrame) -> DataFrame:
    """AGG3: total paid (0 when all NULL), max installments, modal payment type."""
    pos = SEQ if SEQ in raw_payments.columns else "payment_sequential"
    l1 = (raw_payments.filter(F.col("order_id").isNotNull())
          .groupBy("order_id", "payment_type")
          .agg(F.count(F.lit(1)).alias("n_rows"),
               F.min(pos).alias("first_pos"),
               F.sum("payment_value").alias("s_value"),
               F.max("payment_installments").alias("m_inst")))
    return l1.groupBy("order_id").agg(
        F.coalesce(F.sum("s_value"), F.lit(0)).cast("decimal(18,2)").alias("payment_value"),
        F.max("m_inst").alias("payment_installments"),
        _modal("payment_type", "n_rows", "first_pos").alias("payment_type"))


def order_review_rollup(raw_reviews: DataFrame) -> DataFrame:
    """AGG4: mean review score per order."""
    return (raw_reviews.filter(F.col("order_id").isNotNull())
            .groupBy("order_id").agg(F.avg("review_score").alias("review_score")))


def fact_orders(raw_orders: DataFrame, raw_items: DataFrame, raw_payments: DataFrame,
                raw_reviews: DataFrame) -> DataFrame:
    """One row per raw order row with rollups and SLA measures (24 columns)."""
    o = raw_orders
    f = (o.join(merged(order_item_rollup(raw_items)), "order_id", "left")
         .join(merged(order_payment_rollup(raw_payments)), "order_id", "left")
         .join(merged(order_review_rollup(raw_reviews)), "order_id", "left"))

    purchase, approved = F.col("order_purchase_timestamp"), F.col("order_approved_at")
    carrier = F.col("order_delivered_carrier_date")
    delivered = F.col("order_delivered_customer_date")
    estimated = F.col("order_estimated_delivery_date")

    anomaly = F.coalesce(delivered < carrier, F.lit(False))          # PRJ4
    valid = is_valid_delivery(delivered, anomaly)                     # PRJ5
    delay = F.when(valid, days_between(delivered, estimated))        # PRJ6
    f = f.select(
        "*",
        anomaly.alias("timestamp_anomaly_flag"),
        delay.alias("delivery_delay_days"),
        # PRJ7: a valid delivery without an estimate is "not on time" (0), not NULL.
        F.when(valid, F.coalesce(delay <= 0, F.lit(False)).cast("int")).alias("on_time_flag"),
        F.when(approved.isNotNull(), days_between(approved, purchase)).alias("processing_days"),
        F.when(valid & carrier.isNotNull(), days_between(delivered, carrier)).alias("shipping_days"),
        F.when(carrier.isNotNull() & approved.isNotNull(),
               days_between(carrier, approved)).alias("carrier_pickup_days"),
        F.date_format(purchase, "yyyyMMdd").cast("int").alias("date_key"),
    ).withColumnRenamed("primary_seller_id", "seller_id")
    return f.select(*FACT_ORDERS_COLS)
