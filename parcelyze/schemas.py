"""Explicit schemas of the raw contract (never inferred) and names of the
modeled tables. Money is DECIMAL(18,2) so sums are exact; timestamps are NTZ."""

from pyspark.sql import types as T

S, I, D, TS = T.StringType(), T.IntegerType(), T.DoubleType(), T.TimestampNTZType()
MONEY = T.DecimalType(18, 2)


def _st(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


RAW = {
    "raw_orders": _st(("order_id", S), ("customer_id", S), ("order_status", S),
                      ("order_purchase_timestamp", TS), ("order_approved_at", TS),
                      ("order_delivered_carrier_date", TS),
                      ("order_delivered_customer_date", TS),
                      ("order_estimated_delivery_date", TS)),
    "raw_order_items": _st(("order_id", S), ("order_item_id", I), ("product_id", S),
                           ("seller_id", S), ("shipping_limit_date", TS),
                           ("price", MONEY), ("freight_value", MONEY)),
    "raw_order_payments": _st(("order_id", S), ("payment_sequential", I),
                              ("payment_type", S), ("payment_installments", I),
                              ("payment_value", MONEY)),
    "raw_order_reviews": _st(("order_id", S), ("review_score", I)),
    "raw_customers": _st(("customer_id", S), ("customer_unique_id", S),
                         ("customer_zip_code_prefix", I), ("customer_city", S),
                         ("customer_state", S)),
    "raw_sellers": _st(("seller_id", S), ("seller_zip_code_prefix", I),
                       ("seller_city", S), ("seller_state", S)),
    "raw_products": _st(("product_id", S), ("product_category_name", S),
                        ("product_weight_g", D), ("product_length_cm", D),
                        ("product_height_cm", D), ("product_width_cm", D),
                        ("product_photos_qty", D)),
    "raw_geolocation": _st(("geolocation_zip_code_prefix", I), ("geolocation_lat", D),
                           ("geolocation_lng", D), ("geolocation_city", S),
                           ("geolocation_state", S)),
    "raw_category_translation": _st(("product_category_name", S),
                                    ("product_category_name_english", S)),
}

RAW_TABLES = list(RAW)

# Timestamp columns of raw_orders, parsed with a fixed format (NULL on failure).
TS_COLS = ["order_purchase_timestamp", "order_approved_at",
           "order_delivered_carrier_date", "order_delivered_customer_date",
           "order_estimated_delivery_date"]

MODELED_TABLES = ["dim_date", "dim_geography", "dim_customer", "dim_seller",
                  "dim_product", "fact_order_items", "fact_orders"]

# fact_orders column contract, in order.
FACT_ORDERS_COLS = [
    "order_id", "customer_id", "seller_id", "order_status", "date_key",
    "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
    "order_delivered_customer_date", "order_estimated_delivery_date",
    "item_count", "n_sellers", "total_price", "total_freight",
    "payment_value", "payment_installments", "payment_type", "review_score",
    "processing_days", "carrier_pickup_days", "shipping_days",
    "delivery_delay_days", "on_time_flag", "timestamp_anomaly_flag",
]

# The order statuses the raw contract allows.
ALLOWED_ORDER_STATUS = ["delivered", "shipped", "canceled", "unavailable",
                        "invoiced", "processing", "created", "approved"]
