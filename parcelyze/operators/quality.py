"""Data-quality checks on the raw and the modeled layer, as declarations.

``RAW`` and ``MODELED`` are check sets (see ``checks``): each check names its table
and what it demands, and the compiler plans them together. Users add checks of their
own with ``RAW.add(...)`` or to a ``copy()``; they are planned, stored, reported and
drilled into like the built-in ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import r2
from ..schemas import ALLOWED_ORDER_STATUS
from .checks import (RESULT_COLS, CheckSet, Coverage, Domain, Recorded, Reference, RowRule, SameCount,  # noqa: F401
                     UniqueKey, duplicate_key_count, orphan_count, orphan_rows, unexpected_values)

# The status check's all-clear text and the modeled delay bound (days).
ALL_CLEAR_STATUS = "all statuses known"
DELAY_BOUND_DAYS = 200


def _before(later: str, earlier: str):
    """``later`` lies before ``earlier``; a NULL on either side breaks nothing."""
    return lambda: F.coalesce(F.col(later) < F.col(earlier), F.lit(False))


def _extreme_delay():
    d = F.col("delivery_delay_days")
    return d.isNotNull() & (F.abs(d) > DELAY_BOUND_DAYS)


def _flag_contradicts():
    d, flag = F.col("delivery_delay_days"), F.col("on_time_flag")
    return d.isNotNull() & (((flag == 1) & (d > 0)) | ((flag == 0) & (d <= 0)))


# Fixed values below: check names, categories and detail texts of the reference's
# checks, in its order. The status check counts the unexpected values;
# unexpected_values() has one row for each, however many.
RAW = CheckSet("raw", [
    RowRule("raw_orders: order_id not null", "null_check", "{n} null order_id rows",
            table="raw_orders", broken=lambda: F.col("order_id").isNull()),
    UniqueKey("raw_orders: order_id uniqueness (PK)", "duplicate_check", "{n} duplicate order_id values",
              table="raw_orders", keys=("order_id",)),
    UniqueKey("raw_order_items: duplicate (order_id, order_item_id) rows", "duplicate_check",
              "{n} duplicate order_item rows", table="raw_order_items", keys=("order_id", "order_item_id")),
    RowRule("raw_order_items: price/freight not negative", "range_check", "{n} rows with negative price/freight",
            table="raw_order_items", broken=lambda: (F.col("price") < 0) | (F.col("freight_value") < 0)),
    RowRule("raw_order_reviews: review_score within 1-5", "range_check", "{n} out-of-range review scores",
            table="raw_order_reviews", broken=lambda: (F.col("review_score") < 1) | (F.col("review_score") > 5)),
    Reference("referential integrity: order_items.order_id exists in orders", "referential_integrity",
              "{n} order_items rows with no matching order",
              table="raw_order_items", key="order_id", parent="raw_orders", parent_key="order_id"),
    Reference("referential integrity: orders.customer_id exists in customers", "referential_integrity",
              "{n} orders rows with no matching customer",
              table="raw_orders", key="customer_id", parent="raw_customers", parent_key="customer_id"),
    RowRule("business rule: delivered_customer_date >= delivered_carrier_date", "business_rule",
            "{n} orders where customer delivery is before carrier handoff (bad timestamps)",
            table="raw_orders", broken=_before("order_delivered_customer_date", "order_delivered_carrier_date")),
    RowRule("business rule: delivered_carrier_date >= approved_date", "business_rule",
            "{n} orders where carrier handoff is before approval (bad timestamps)",
            table="raw_orders", broken=_before("order_delivered_carrier_date", "order_approved_at")),
    Domain("schema: raw_orders has expected order_status values", "schema_validation",
           "unexpected status values: {n} (listed by unexpected_values)",
           table="raw_orders", column="order_status", allowed=tuple(ALLOWED_ORDER_STATUS), clear=ALL_CLEAR_STATUS),
    RowRule("null_check: delivered orders missing delivered_customer_date", "null_check",
            "{n} orders marked 'delivered' but missing a delivered_customer_date", table="raw_orders",
            broken=lambda: (F.col("order_status") == "delivered") & F.col("order_delivered_customer_date").isNull()),
    Recorded("freshness_check(simulated): pipeline run timestamp recorded", "freshness_check",
             "pipeline executed at {run_ts}"),
])
MODELED = CheckSet("modeled", [
    UniqueKey("fact_orders: order_id uniqueness (PK)", "duplicate_check", "{n} duplicate order_id in fact_orders",
              table="fact_orders", keys=("order_id",)),
    Reference("referential integrity: fact_orders.customer_id -> dim_customer", "referential_integrity",
              "{n} fact_orders rows with no matching dim_customer",
              table="fact_orders", key="customer_id", parent="dim_customer", parent_key="customer_id"),
    Reference("referential integrity: fact_order_items.product_id -> dim_product", "referential_integrity",
              "{n} fact_order_items rows with no matching dim_product",
              table="fact_order_items", key="product_id", parent="dim_product", parent_key="product_id"),
    RowRule("range_check: delivery_delay_days within +/-200 days", "range_check",
            "{n} extreme delay outliers (possible residual data errors)", table="fact_orders", broken=_extreme_delay),
    RowRule("business_rule: on_time_flag consistent with delivery_delay_days sign", "business_rule",
            "{n} rows where on_time_flag contradicts delivery_delay_days", table="fact_orders", broken=_flag_contradicts),
    SameCount("schema_validation: fact_orders has expected row count vs raw_orders", "schema_validation",
              "raw_orders={other_count} vs fact_orders={count}", table="fact_orders", other="raw_orders"),
    Coverage("coverage: pct of orders with a valid delivery_delay_days", "business_rule",
             "{pct}% of orders have a computable SLA delay ({valid}/{total})",
             table="fact_orders", column="delivery_delay_days"),
])


def model_tables(model, raw_orders: DataFrame | None = None):
    """Tables of a model and its raw layer by name."""
    def get(name):
        if name.startswith("raw_"):
            return raw_orders if name == "raw_orders" and raw_orders is not None else model.raw[name]
        return getattr(model, name)
    return get


def raw_checks(raw, run_ts: str, checks: CheckSet | None = None) -> DataFrame:
    """The raw-layer checks (DQ1-DQ12, or ``checks``) as result rows. raw_orders is
    scanned three times, once per key it is grouped by; raw_order_items once, by line
    and from there by order."""
    return (checks or RAW).compile(raw, run_ts)


def modeled_checks(model, raw_orders: DataFrame, run_ts: str, checks: CheckSet | None = None) -> DataFrame:
    """The modeled-layer checks (DM1-DM7, or ``checks``) as result rows."""
    return (checks or MODELED).compile(model_tables(model, raw_orders), run_ts)


def violating_rows(layer: str, check_id: int, raw=None, model=None, checks: CheckSet | None = None) -> DataFrame:
    """The rows behind a row-level or referential check (what the counts count), as
    a lazy DataFrame; uniqueness checks return the duplicated keys."""
    found = checks or (RAW if layer == "raw" else MODELED)
    return found.rows(check_id, raw if layer == "raw" else model_tables(model))


# ------------------------------------------------------- SQL mirror / views
def sql_check_counts(model) -> DataFrame:
    """DS1-DS5: the pure-SQL mirror counts as one row of five columns."""
    f = model.fact_orders
    fused = f.agg(F.count_if(_extreme_delay()).alias("extreme_delay_outliers"),
                  F.count_if(_flag_contradicts()).alias("inconsistent_on_time_flag"))
    c = orphan_count(f, "customer_id", model.dim_customer, "customer_id").select("v").scalar()
    p = orphan_count(model.fact_order_items, "product_id", model.dim_product, "product_id") \
        .select("v").scalar()
    dup = duplicate_key_count(f, ["order_id"]).select("v").scalar()
    return fused.select(c.alias("orphaned_customer_fk"), p.alias("orphaned_product_fk"),
                        "extreme_delay_outliers", "inconsistent_on_time_flag",
                        dup.alias("duplicate_order_pk"))


def dq_report(results: DataFrame) -> DataFrame:
    """DD1: display form, Passed 1 -> 'Yes', 0 -> 'Flagged', newest first."""
    return (results.orderBy(F.col("run_ts").desc(), "layer", "check_id")
            .select("check_name", "category",
                    F.when(F.col("passed") == 1, "Yes").otherwise("Flagged").alias("passed"),
                    "detail"))


def dq_health(results: DataFrame) -> DataFrame:
    """AGG19: pass rate (%, 1 decimal) and pass / fail counts."""
    return results.agg(r2(F.lit(100.0) * F.avg("passed"), 1).alias("pass_rate"),
                       F.count_if(F.col("passed") == 1).alias("n_passed"),
                       F.count_if(F.col("passed") == 0).alias("n_flagged"),
                       F.count(F.lit(1)).alias("n_checks"))
