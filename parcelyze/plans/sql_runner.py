"""SRC5: the six operational questions as Spark SQL files, run by name with
bound parameters (``spark.sql(text, args=...)``) over temp views of a model.

The DataFrame functions in operators/analytics.py are the primary API; these SQL
texts are the same questions for users who work in SQL, shaped the same way
(pre-aggregated before dimension joins, snapped before rounding), and both are
registered against DuckDB twins. The
one step plain SQL would run in a single task -- RANK() over all sellers -- is
applied after the SQL with the distributed rank operator.
"""

from __future__ import annotations

import re
from importlib import resources

from pyspark.sql import DataFrame, SparkSession

# Default bound parameters per query file.
DEFAULTS = {
    "monthly_kpis": {},
    "seller_scorecard": {"min_orders": 5},
    "state_performance": {"min_orders": 20},
    "seller_month_anomalies": {"min_orders": 3, "threshold": 2.0},
    "root_cause_breakdown": {},
    "payment_vs_outcome": {},
}
PARAMETERIZED = {"root_cause_breakdown"}     # needs a caller-supplied seller_id


def sql_text(name: str) -> str:
    return resources.files(__package__).joinpath("sql", f"{name}.sql").read_text()


def parameters(text: str) -> set:
    """Names of the :markers of a query text, outside comments and quoted text."""
    bare = re.sub(r"--[^\n]*|/\*.*?\*/|'(?:[^']|'')*'", " ", text, flags=re.S)
    return set(re.findall(r"(?<!:):([A-Za-z_]\w*)", bare))


def register_views(model, text: str) -> None:
    """Expose the model tables that a query text names as temp views."""
    for name in ["dim_date", "dim_geography", "dim_customer", "dim_seller", "dim_product",
                 "fact_order_items", "fact_orders"]:
        if re.search(rf"\b{name}\b", text):
            getattr(model, name).createOrReplaceTempView(name)


def run_query(spark: SparkSession, model, name: str, params: dict | None = None) -> DataFrame:
    """Run one named query file with its bound parameters (named markers). A
    marker without a value, or a value without a marker, is an error."""
    text = sql_text(name)
    wanted, args = parameters(text), {**DEFAULTS[name], **(params or {})}
    missing = sorted(k for k in wanted if args.get(k) is None)
    unknown = sorted(args.keys() - wanted)
    if missing or unknown:
        raise ValueError(f"query {name}: missing parameters {missing}, unknown parameters {unknown}")
    register_views(model, text)
    df = spark.sql(text, args=args) if args else spark.sql(text)
    return POST.get(name, lambda d: d)(df)


def _rank_sellers(df: DataFrame) -> DataFrame:
    from pyspark.sql import functions as F

    from ..operators.ranking import global_rank
    ranked = global_rank(df, "on_time_ratio", "worst_on_time_rank")
    return (ranked.drop("on_time_ratio")
            .orderBy(F.col("on_time_pct").asc_nulls_first(), "seller_id"))


# Steps that SQL would run in one task (a global RANK()), done with the
# distributed operator after the SQL text.
POST = {"seller_scorecard": _rank_sellers}


def run_all(spark: SparkSession, model) -> dict:
    """Every non-parameterized query file -> lazy DataFrame."""
    return {n: run_query(spark, model, n) for n in DEFAULTS if n not in PARAMETERIZED}
