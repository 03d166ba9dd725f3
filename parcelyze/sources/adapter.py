"""Test-data adapter: the driver's TPC-H-style tables -> the 9-table raw
fulfilment model (orders, items, payments, reviews, customers, sellers,
products, geolocation, category translation).

Everything is integer arithmetic on keys so that Spark and the DuckDB oracle
produce identical rows. Each raw table is a narrow projection of one driver
table (plus a key join for orders -> customer nation), so the adapter scales
with the input and adds no shuffle beyond that one join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RAW
from ..session import merged
from .testdata import read_driver_table

# Fixed values of the adapter (shared with the DuckDB oracle text).
PURCHASE_BASE = "2017-01-01 00:00:00"   # first purchase day of the mapped calendar
ORDER_DATE_BASE = "1995-01-01"          # first o_orderdate of the driver data
PAYMENT_TYPES = ["credit_card", "credit_card", "credit_card", "credit_card",
                 "boleto", "voucher", "debit_card"]   # indexed by o_orderkey % 7


def _days(base: Column, n: Column) -> Column:
    return F.timestamp_add("DAY", n, base)


@dataclass
class RawModel:
    """The raw layer as lazy DataFrames, keyed by raw table name."""
    tables: dict

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    def items(self):
        return self.tables.items()


def _cast_to_contract(name: str, df: DataFrame) -> DataFrame:
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW[name].fields])


def raw_model(spark: SparkSession, sf_dir: str) -> RawModel:
    t = lambda n: read_driver_table(spark, sf_dir, n)
    orders, lineitem, customer = t("orders"), t("lineitem"), t("customer")
    supplier, part, nation = t("supplier"), t("part"), t("nation")

    # Number of suppliers: a one-value scalar subquery, never a join.
    n_supp = supplier.select(F.count(F.lit(1))).scalar()

    k = F.col("o_orderkey")
    cust_nation = customer.select(F.col("c_custkey").alias("o_custkey"),
                                  F.col("c_nationkey").alias("nk"))
    o = orders.join(merged(cust_nation), "o_custkey", "left")
    p = _days(F.expr(f"TIMESTAMP_NTZ '{PURCHASE_BASE}'"),
              F.expr(f"datediff(to_date(o_orderdate), DATE '{ORDER_DATE_BASE}') div 4"))
    status = (F.when(k % 50 == 7, "canceled").when(k % 50 == 8, "shipped")
              .otherwise("delivered"))
    carrier = _days(p, 1 + k % 3 + (k * 7) % 5 - F.when(k % 53 == 0, 6).otherwise(0))
    transit = (F.when(k % 89 == 0, F.lit(-2))
               .otherwise(2 + (k * 13) % 9 + F.col("nk") % 5
                          + F.when((k % n_supp) % 10 == 3, 12).otherwise(0)))
    raw_orders = o.select(
        k.cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        status.alias("order_status"),
        p.alias("order_purchase_timestamp"),
        F.when(k % 97 != 0, _days(p, k % 3)).alias("order_approved_at"),
        F.when(status != "canceled", carrier).alias("order_delivered_carrier_date"),
        F.when((status == "delivered") & (k % 211 != 0), _days(carrier, transit))
        .alias("order_delivered_customer_date"),
        _days(p, F.lit(18)).alias("order_estimated_delivery_date"),
    )

    lk = F.col("l_orderkey")
    raw_items = lineitem.select(
        lk.cast("string").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.when(lk % 8 == 0, F.col("l_suppkey")).otherwise(lk % n_supp)
        .cast("string").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        F.round(F.col("l_quantity") * 0.5, 2).alias("freight_value"),
    )

    # Payments: one row per order (k % 199 != 0); a second voucher row when
    # k % 5 == 0, the price split in whole cents. A generator, not a self-union.
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    split = k % 5 == 0
    first_cents = F.when(split, F.expr("cast(round(o_totalprice * 100) as bigint) div 2")).otherwise(cents)
    ptype = F.element_at(F.array(*[F.lit(x) for x in PAYMENT_TYPES]), (k % 7 + 1).cast("int"))
    rows = F.array(
        F.struct(F.lit(1).alias("payment_sequential"), ptype.alias("payment_type"),
                 (1 + k % 10).alias("payment_installments"), first_cents.alias("cents")),
        F.when(split, F.struct(F.lit(2).alias("payment_sequential"),
                               F.lit("voucher").alias("payment_type"),
                               F.lit(1).cast("long").alias("payment_installments"),
                               (cents - first_cents).alias("cents"))),
    )
    raw_payments = (orders.filter(k % 199 != 0)
                    .select(k.cast("string").alias("order_id"),
                            F.inline(F.filter(rows, lambda r: r.isNotNull())))
                    .withColumn("payment_value", F.col("cents") / 100))

    # Reviews derive from the adapted orders (late deliveries score low).
    ok = F.col("order_id").cast("long")
    late = F.col("order_delivered_customer_date") > F.col("order_estimated_delivery_date")
    score = F.when(late, 1 + ok % 3).otherwise(3 + ok % 3)
    review_rows = F.array(F.when(ok % 23 != 0, score), F.when(ok % 41 == 0, F.lit(1).cast("long")))
    raw_reviews = (raw_orders.select("order_id", "order_delivered_customer_date",
                                     "order_estimated_delivery_date")
                   .select("order_id", F.explode(F.filter(review_rows, lambda r: r.isNotNull()))
                           .alias("review_score")))

    nat = nation.select("n_nationkey", "n_name")
    cn = customer.join(nat, customer.c_nationkey == nat.n_nationkey, "left")
    raw_customers = cn.select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        F.expr("c_custkey div 4").alias("customer_zip_code_prefix"),
        F.col("c_mktsegment").alias("customer_city"),
        F.col("n_name").alias("customer_state"),
    )
    raw_geolocation = cn.select(
        F.expr("c_custkey div 4").alias("geolocation_zip_code_prefix"),
        (F.col("c_acctbal") / 1000).alias("geolocation_lat"),
        (-F.col("c_acctbal") / 500).alias("geolocation_lng"),
        F.col("c_mktsegment").alias("geolocation_city"),
        F.col("n_name").alias("geolocation_state"),
    )
    raw_sellers = (supplier.join(nat, supplier.s_nationkey == nat.n_nationkey, "left")
                   .select(F.col("s_suppkey").cast("string").alias("seller_id"),
                           F.col("s_suppkey").alias("seller_zip_code_prefix"),
                           F.col("s_name").alias("seller_city"),
                           F.col("n_name").alias("seller_state")))
    raw_products = part.select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.when(F.col("p_partkey") % 61 != 0, F.col("p_type")).alias("product_category_name"),
        F.col("p_retailprice").alias("product_weight_g"),
        F.col("p_size").alias("product_length_cm"),
        (F.col("p_size") * 0.5).alias("product_height_cm"),
        (F.col("p_size") * 0.25).alias("product_width_cm"),
        (F.col("p_partkey") % 7).alias("product_photos_qty"),
    )
    raw_translation = (part.select("p_type").filter(F.col("p_type") != "PROMO").distinct()
                       .select(F.col("p_type").alias("product_category_name"),
                               F.concat(F.lit("en_"), F.lower("p_type"))
                               .alias("product_category_name_english")))

    tables = {
        "raw_orders": raw_orders, "raw_order_items": raw_items,
        "raw_order_payments": raw_payments, "raw_order_reviews": raw_reviews,
        "raw_customers": raw_customers, "raw_sellers": raw_sellers,
        "raw_products": raw_products, "raw_geolocation": raw_geolocation,
        "raw_category_translation": raw_translation,
    }
    return RawModel({n: _cast_to_contract(n, df) for n, df in tables.items()})


# ------------------------------------------------------- seeded violations
def _twice(df: DataFrame, when: Column) -> DataFrame:
    return df.withColumn("_twice", F.explode(F.sequence(F.lit(1), F.when(when, 2).otherwise(1)))).drop("_twice")


def dirty_raw(raw) -> RawModel:
    """The raw tables with every kind of violation that the raw checks look for,
    seeded by key arithmetic: NULL and repeated keys, orphans, unknown and NULL
    statuses (more kinds than a person would list), reversed and missing dates,
    extreme delays, negative amounts and scores out of range."""
    day = F.expr("INTERVAL 1 DAY")
    k = F.col("order_id").cast("long")
    o = _twice(raw["raw_orders"].withColumn("_k", k), F.col("_k") % 401 == 0)
    key = F.col("_k")
    orders = o.select(
        F.when(key % 997 != 0, F.col("order_id")).alias("order_id"),
        F.when(key % 499 == 0, F.concat(F.lit("X"), "customer_id")).otherwise(F.col("customer_id")).alias("customer_id"),
        F.when(key % 331 == 0, F.concat(F.lit("lost "), (key % 40).cast("string")))
        .when(key % 337 != 0, F.col("order_status")).alias("order_status"),
        "order_purchase_timestamp", "order_approved_at",
        F.when(key % 211 == 1, F.col("order_approved_at") - day * 2)
        .otherwise(F.col("order_delivered_carrier_date")).alias("order_delivered_carrier_date"),
        F.when(key % 503 == 0, F.col("order_delivered_customer_date") + day * 300)
        .when(key % 223 != 1, F.col("order_delivered_customer_date")).alias("order_delivered_customer_date"),
        "order_estimated_delivery_date")
    i = _twice(raw["raw_order_items"].withColumn("_k", k), F.col("_k") % 311 == 0)
    items = i.select(
        F.when(key % 409 == 0, F.concat(F.lit("Y"), "order_id")).when(key % 419 != 0, F.col("order_id")).alias("order_id"),
        "order_item_id",
        F.when(key % 307 == 0, F.concat(F.lit("P"), "product_id")).otherwise(F.col("product_id")).alias("product_id"),
        "seller_id", "shipping_limit_date",
        F.when(key % 101 == 0, -F.col("price")).otherwise(F.col("price")).alias("price"),
        F.when(key % 103 == 0, -1 - F.col("freight_value")).otherwise(F.col("freight_value")).alias("freight_value"))
    reviews = raw["raw_order_reviews"].withColumn(
        "review_score", F.when(k % 113 == 0, 0).when(k % 113 == 1, 6).otherwise(F.col("review_score")))
    changed = {"raw_orders": orders, "raw_order_items": items, "raw_order_reviews": reviews}
    return RawModel({n: _cast_to_contract(n, changed[n]) if n in changed else df for n, df in raw.items()})


def dirty_facts(fact: DataFrame) -> DataFrame:
    """fact_orders with lost rows and flipped flags, which the modeled checks look for."""
    k = F.col("order_id").cast("long")
    return fact.filter(F.col("order_id").isNull() | (k % 109 != 0)).withColumn(
        "on_time_flag", F.when(k % 127 == 0, 1 - F.col("on_time_flag")).otherwise(F.col("on_time_flag")))
