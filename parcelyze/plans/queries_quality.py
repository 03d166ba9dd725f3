"""Registered data-quality queries and their DuckDB twins."""

from __future__ import annotations

import threading
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators.reconcile import reconcile
from ..schemas import ALLOWED_ORDER_STATUS
from ..session import app_id, materialize
from .oracle import R, dirty_ctes
from .registry import _raw, dirty_model, model, query

# Run timestamp used by the registered (deterministic) DQ queries; the
# pipeline passes the real run time.
REPORT_TS = "2018-09-01T00:00:00+00:00"


def _sq(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_RAW_SPEC = {c.check_id: (c.check_id, c.name, c.category, c.detail) for c in Q.RAW.checks}
_MOD_SPEC = {c.check_id: (c.check_id, c.name, c.category, c.detail) for c in Q.MODELED.checks}
_ALLOWED = ", ".join(f"({_sq(s)})" for s in ALLOWED_ORDER_STATUS)


def _results_sql(layer: str, specs: dict, one_row: str, detail: dict, always: set) -> str:
    """Result rows of a layer from one row of counts c1, c2, ...: a list of structs,
    unnested. ``detail``: texts that are more than "{n} ..."; ``always``: checks
    that pass whatever they count."""
    items = []
    for cid, (_, name, category, template) in specs.items():
        before, _, after = template.partition("{n}")
        text = detail.get(cid, f"{_sq(before)} || c{cid}::VARCHAR || {_sq(after)}")
        items.append(f"{{'check_id': {cid}, 'check_name': {_sq(name)}, 'category': {_sq(category)}, "
                     f"'n': c{cid}::BIGINT, 'ok': {'true' if cid in always else f'c{cid} = 0'}, 'detail': {text}}}")
    return (f"SELECT {_sq(layer)} AS layer, r.check_id, r.check_name, r.category, r.ok::INTEGER AS passed, "
            f"r.n AS violations, r.detail, {_sq(REPORT_TS)} AS run_ts\n"
            f"FROM (SELECT unnest([{', '.join(items)}]) AS r FROM {one_row})")


def _repeated(keys: str, table: str, name: str) -> str:
    """How many key values a table holds more than once."""
    return (f"(SELECT count(*) FILTER (WHERE copies > 1) AS {name} "
            f"FROM (SELECT count(*) AS copies FROM {table} GROUP BY {keys}))")


def _unmatched(child: str, parent: str, key: str, name: str) -> str:
    """Child rows without a parent; an absent key has none."""
    return f"(SELECT count(*) AS {name} FROM {child} ANTI JOIN {parent} USING ({key}))"


RAW_DQ_SQL = _results_sql("raw", _RAW_SPEC, f"""
  (SELECT count(*) - count(order_id) AS c1,
          count(*) FILTER (order_delivered_customer_date < order_delivered_carrier_date) AS c8,
          count(*) FILTER (order_delivered_carrier_date < order_approved_at) AS c9,
          count(*) FILTER (order_status = 'delivered') - count(order_delivered_customer_date)
            FILTER (order_status = 'delivered') AS c11, 0 AS c12
   FROM raw_orders),
  {_repeated('order_id', 'raw_orders', 'c2')},
  {_repeated('order_id, order_item_id', 'raw_order_items', 'c3')},
  (SELECT count(*) FILTER (least(price, freight_value) < 0) AS c4 FROM raw_order_items),
  (SELECT count(*) FILTER (review_score NOT BETWEEN 1 AND 5) AS c5 FROM raw_order_reviews),
  {_unmatched('raw_order_items', 'raw_orders', 'order_id', 'c6')},
  {_unmatched('raw_orders', 'raw_customers', 'customer_id', 'c7')},
  (SELECT count(*) AS c10 FROM (SELECT DISTINCT order_status FROM raw_orders)
   ANTI JOIN (VALUES {_ALLOWED}) AS allowed(order_status) USING (order_status))""",
    {10: f"CASE c10 WHEN 0 THEN {_sq(Q.ALL_CLEAR_STATUS)} ELSE "
         f"replace({_sq(_RAW_SPEC[10][3])}, '{{n}}', c10::VARCHAR) END",
     12: _sq(_RAW_SPEC[12][3].format(run_ts=REPORT_TS))}, {12})

MODELED_DQ_SQL = _results_sql("modeled", _MOD_SPEC, f"""
  (SELECT *, abs(raw_n - fact_n) AS c6, fact_n - valid AS c7
   FROM (SELECT count(*) AS fact_n, count(delivery_delay_days) AS valid,
                count(*) FILTER (delivery_delay_days NOT BETWEEN -{Q.DELAY_BOUND_DAYS} AND {Q.DELAY_BOUND_DAYS}) AS c4,
                count(*) FILTER ((on_time_flag = 1) <> (delivery_delay_days <= 0)) AS c5
         FROM fact_orders),
        (SELECT count(*) AS raw_n FROM raw_orders)),
  {_repeated('order_id', 'fact_orders', 'c1')},
  {_unmatched('fact_orders', 'dim_customer', 'customer_id', 'c2')},
  {_unmatched('fact_order_items', 'dim_product', 'product_id', 'c3')}""",
    {6: "format('raw_orders={:,} vs fact_orders={:,}', raw_n, fact_n)",
     7: f"printf('%.1f', {R('100.0::DOUBLE * valid / NULLIF(fact_n, 0)', 1)}) || "
        "format('% of orders have a computable SLA delay ({:,}/{:,})', valid, fact_n)"}, {7})


def _raw_dq(spark, sf_dir):
    return Q.raw_checks(_raw(spark, sf_dir), REPORT_TS)


def _mod_dq(spark, sf_dir):
    m = model(spark, sf_dir)
    return Q.modeled_checks(m, m.raw["raw_orders"], REPORT_TS)


_DQ_TABLES: dict = {}
_DQ_LOCK = threading.Lock()


def dq_results(spark, sf_dir):
    """The stored data_quality_results table (raw + modeled rows), computed once
    per application and input folder and written next to the model, as the
    pipeline stores it; report queries read it like the dashboard does."""
    key = (app_id(spark), sf_dir.rstrip("/"))
    with _DQ_LOCK:
        if key not in _DQ_TABLES:
            _DQ_TABLES[key] = materialize(_raw_dq(spark, sf_dir).unionByName(_mod_dq(spark, sf_dir)),
                                          "data_quality_results")
        return _DQ_TABLES[key]


@query("dq_raw_checks", RAW_DQ_SQL)
def q_dq_raw_checks(spark, sf_dir):
    return _raw_dq(spark, sf_dir)


@query("dq_modeled_checks", MODELED_DQ_SQL)
def q_dq_modeled_checks(spark, sf_dir):
    return _mod_dq(spark, sf_dir)


_ALL_DQ = f"(SELECT * FROM ({RAW_DQ_SQL}) UNION ALL SELECT * FROM ({MODELED_DQ_SQL}))"


@query("dq_report", f"""
SELECT check_name, category, CASE WHEN passed = 1 THEN 'Yes' ELSE 'Flagged' END AS passed, detail
FROM {_ALL_DQ}""")
def q_dq_report(spark, sf_dir):
    return Q.dq_report(dq_results(spark, sf_dir))


@query("dq_health", f"""
SELECT {R('CAST(100.0 AS DOUBLE) * AVG(passed)', 1)} AS pass_rate,
       COUNT(*) FILTER (WHERE passed = 1) AS n_passed, COUNT(*) FILTER (WHERE passed = 0) AS n_flagged,
       COUNT(*) AS n_checks
FROM {_ALL_DQ}""")
def q_dq_health(spark, sf_dir):
    return Q.dq_health(dq_results(spark, sf_dir))


_SQL_COUNTS = f"""
SELECT c2 AS orphaned_customer_fk, c3 AS orphaned_product_fk, c4 AS extreme_delay_outliers,
       c5 AS inconsistent_on_time_flag, c1 AS duplicate_order_pk
FROM {_repeated('order_id', 'fact_orders', 'c1')},
     {_unmatched('fact_orders', 'dim_customer', 'customer_id', 'c2')},
     {_unmatched('fact_order_items', 'dim_product', 'product_id', 'c3')},
     (SELECT count(*) FILTER (abs(delivery_delay_days) > {Q.DELAY_BOUND_DAYS}) AS c4,
             count(*) FILTER ((on_time_flag = 1) <> (delivery_delay_days <= 0)) AS c5 FROM fact_orders)"""


@query("dq_sql_counts", _SQL_COUNTS)
def q_dq_sql_counts(spark, sf_dir):
    return Q.sql_check_counts(model(spark, sf_dir))


_RELATIONS = [
    ("raw_order_items.order_id -> raw_orders", "raw_order_items", "raw_orders", "order_id"),
    ("raw_orders.customer_id -> raw_customers", "raw_orders", "raw_customers", "customer_id"),
    ("fact_orders.customer_id -> dim_customer", "fact_orders", "dim_customer", "customer_id"),
    ("fact_order_items.product_id -> dim_product", "fact_order_items", "dim_product", "product_id")]
_KEYS = [("raw_orders(order_id)", "raw_orders", "order_id"),
         ("raw_order_items(order_id, order_item_id)", "raw_order_items", "order_id, order_item_id"),
         ("fact_orders(order_id)", "fact_orders", "order_id")]
_ORPHANS = " UNION ALL ".join(
    f"SELECT {_sq(n)} AS relationship, v AS orphan_count FROM {_unmatched(c, p, k, 'v')}" for n, c, p, k in _RELATIONS)


@query("orphan_rows", _ORPHANS)
def q_orphan_rows(spark, sf_dir):
    return _orphan_counts(model(spark, sf_dir))


def _table(m, name: str):
    return m.raw[name] if name.startswith("raw_") else getattr(m, name)


def _orphan_counts(m):
    parts = [Q.orphan_count(_table(m, c), k, _table(m, p), k).select(F.lit(n).alias("relationship"),
                                                                   F.col("v").alias("orphan_count"))
             for n, c, p, k in _RELATIONS]
    return reduce(DataFrame.unionByName, parts)


@query("duplicate_keys", " UNION ALL ".join(
    f"SELECT {_sq(n)} AS table_key, v AS duplicate_count FROM {_repeated(k, t, 'v')}" for n, t, k in _KEYS))
def q_duplicate_keys(spark, sf_dir):
    m = model(spark, sf_dir)
    return reduce(DataFrame.unionByName, [
        Q.duplicate_key_count(_table(m, t), k.split(", ")).select(F.lit(n).alias("table_key"),
                                                                  F.col("v").alias("duplicate_count"))
        for n, t, k in _KEYS])


_UNEXPECTED = f"""
SELECT order_status, count(*) AS row_count
FROM raw_orders ANTI JOIN (VALUES {_ALLOWED}) AS allowed(order_status) USING (order_status)
GROUP BY ALL"""


@query("unexpected_status", _UNEXPECTED)
def q_unexpected_status(spark, sf_dir):
    return Q.unexpected_values(_raw(spark, sf_dir)["raw_orders"], "order_status", ALLOWED_ORDER_STATUS)


# ------------------------------------------- the checks on seeded violations
# The adapter's tables satisfy most rules, so the queries above mostly count zeros.
# These run on a variant with every kind of violation seeded by key arithmetic.
@query("dirty_raw_checks", RAW_DQ_SQL, dirty_ctes)
def q_dirty_raw_checks(spark, sf_dir):
    """DQ1-DQ12 where every rule is broken."""
    return Q.raw_checks(dirty_model(spark, sf_dir).raw, REPORT_TS)


@query("dirty_modeled_checks", MODELED_DQ_SQL, dirty_ctes)
def q_dirty_modeled_checks(spark, sf_dir):
    """DM1-DM7 where every rule is broken."""
    m = dirty_model(spark, sf_dir)
    return Q.modeled_checks(m, m.raw["raw_orders"], REPORT_TS)


@query("dirty_sql_counts", _SQL_COUNTS, dirty_ctes)
def q_dirty_sql_counts(spark, sf_dir):
    """DS1-DS5 where every rule is broken."""
    return Q.sql_check_counts(dirty_model(spark, sf_dir))


@query("dirty_orphan_rows", _ORPHANS, dirty_ctes)
def q_dirty_orphan_rows(spark, sf_dir):
    return _orphan_counts(dirty_model(spark, sf_dir))


@query("dirty_unexpected_status", _UNEXPECTED, dirty_ctes)
def q_dirty_unexpected_status(spark, sf_dir):
    return Q.unexpected_values(dirty_model(spark, sf_dir).raw["raw_orders"], "order_status", ALLOWED_ORDER_STATUS)


@query("dirty_item_orphans", """
SELECT order_id, order_item_id, product_id FROM raw_order_items ANTI JOIN raw_orders USING (order_id)""", dirty_ctes)
def q_dirty_item_orphans(spark, sf_dir):
    """The drill-down of a referential check: the violating rows themselves."""
    return Q.violating_rows("raw", 6, raw=dirty_model(spark, sf_dir).raw).select(
        "order_id", "order_item_id", "product_id")


# ----------------------------------------------------------- checks of a user
def user_checks() -> Q.CheckSet:
    """The raw checks and some that a user of the library might add, of every kind."""
    checks = Q.RAW.copy()
    checks.add(Q.UniqueKey("sellers once", "duplicate_check", "{n} repeated sellers", table="raw_sellers", keys=("seller_id",)))
    checks.add(Q.Reference("items.seller_id exists in sellers", "referential_integrity", "{n} items without a seller",
                           table="raw_order_items", key="seller_id", parent="raw_sellers", parent_key="seller_id"))
    checks.add(Q.Reference("payments.order_id exists in orders", "referential_integrity", "{n} payments without an order",
                           table="raw_order_payments", key="order_id", parent="raw_orders", parent_key="order_id"))
    checks.add(Q.Reference("reviews.order_id exists in orders", "referential_integrity", "{n} reviews without an order",
                           table="raw_order_reviews", key="order_id", parent="raw_orders", parent_key="order_id"))
    checks.add(Q.RowRule("freight above the price", "business_rule", "{n} items with more freight than price",
                         table="raw_order_items", broken=lambda: F.col("freight_value") > F.col("price")))
    checks.add(Q.Domain("payment types", "schema_validation", "{n} other payment types", table="raw_order_payments",
                        column="payment_type", allowed=("credit_card", "boleto"), clear="no other payment type"))
    checks.add(Q.SameCount("as many orders as customers", "schema_validation", "{count} orders, {other_count} customers",
                           table="raw_orders", other="raw_customers"))
    checks.add(Q.Coverage("orders with an approval", "business_rule", "{pct}% approved ({valid}/{total})",
                          table="raw_orders", column="order_approved_at"))

    @checks.check("orders of several sellers", "business_rule", "{n} orders of several sellers")
    def several(tables):
        per = tables("raw_order_items").groupBy("order_id").agg(F.min("seller_id").alias("x"), F.max("seller_id").alias("y"))
        return per.agg(F.count_if(F.col("x") < F.col("y")).alias("v"))
    return checks


_USER = {c.check_id: (c.check_id, c.name, c.category, c.detail) for c in user_checks().checks if c.check_id > 12}
USER_DQ_SQL = RAW_DQ_SQL + " UNION ALL " + _results_sql("raw", _USER, f"""
  {_repeated('seller_id', 'raw_sellers', 'c13')},
  {_unmatched('raw_order_items', 'raw_sellers', 'seller_id', 'c14')},
  {_unmatched('raw_order_payments', 'raw_orders', 'order_id', 'c15')},
  {_unmatched('raw_order_reviews', 'raw_orders', 'order_id', 'c16')},
  (SELECT count(*) FILTER (freight_value > price) AS c17 FROM raw_order_items),
  (SELECT count(*) AS c18 FROM (SELECT DISTINCT payment_type FROM raw_order_payments)
   WHERE payment_type IS NULL OR payment_type NOT IN ('credit_card', 'boleto')),
  (SELECT o_n, c_n, valid, abs(o_n - c_n) AS c19, o_n - valid AS c20
   FROM (SELECT count(*) AS o_n, count(order_approved_at) AS valid FROM raw_orders),
        (SELECT count(*) AS c_n FROM raw_customers)),
  (SELECT count(*) AS c21 FROM (SELECT order_id FROM raw_order_items GROUP BY order_id HAVING count(DISTINCT seller_id) > 1))""",
    {18: "CASE c18 WHEN 0 THEN 'no other payment type' ELSE c18::VARCHAR || ' other payment types' END",
     19: "format('{:,} orders, {:,} customers', o_n, c_n)",
     20: f"printf('%.1f', {R('100.0::DOUBLE * valid / NULLIF(o_n, 0)', 1)}) || format('% approved ({{:,}}/{{:,}})', valid, o_n)"},
    {20})


@query("dirty_user_checks", USER_DQ_SQL, dirty_ctes)
def q_dirty_user_checks(spark, sf_dir):
    """The raw checks and nine more that a user registered, planned together, where
    rules are broken."""
    return Q.raw_checks(dirty_model(spark, sf_dir).raw, REPORT_TS, user_checks())


# ------------------------------------------------------------- reconciliation
_SHARED = ["order_id", "customer_id", "order_status", "order_purchase_timestamp"]


@query("dirty_reconciliation", f"""
SELECT {', '.join(_SHARED)}, greatest(sum(s), 0)::BIGINT AS left_only, greatest(-sum(s), 0)::BIGINT AS right_only
FROM (SELECT {', '.join(_SHARED)}, 1 AS s FROM raw_orders UNION ALL SELECT {', '.join(_SHARED)}, -1 FROM fact_orders)
GROUP BY {', '.join(_SHARED)} HAVING sum(s) <> 0""", dirty_ctes)
def q_dirty_reconciliation(spark, sf_dir):
    """DM6 beyond the two counts: the orders that the raw layer and the fact table do
    not share, found by digests per key range."""
    m = dirty_model(spark, sf_dir)
    return reconcile(m.raw["raw_orders"], m.fact_orders, "order_id", _SHARED)
