"""Registered forecast, findings, dashboard and pipeline queries, with twins."""

from __future__ import annotations

import threading
import uuid
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import analytics as A
from ..operators import findings as G
from ..operators import forecast as H
from ..operators import reports as P
from ..operators import quality as Q
from ..operators import stats as S
from ..operators.ranking import global_rank
from ..operators.model import TableModel
from ..session import app_id, drop_folders, merged, scratch_path, shuffles_dropped
from ..sources.adapter import raw_model
from ..sources.ingest import (extra_columns, infer_types, ingest_csv, read_csv_text, read_raw_layer, row_counts, type_raw,
                              write_csv)
from .oracle import FMT, R
from .pipeline import run_pipeline, write_dq
from .snapshots import run_snapshot
from .queries_quality import _ALL_DQ, REPORT_TS, _sq, dq_results
from .queries_stats import _Z
from .registry import _MONTHLY_SQL, _ROOT_CAUSE_SQL, model, query
from .sql_runner import run_query

# ------------------------------------------------------------------ forecast
TRIM_START, TRIM_END = "2017-01", "2018-08"
FIXED_ALPHA, FIXED_BETA = 0.6, 0.2
HORIZON = 3


def _trimmed(spark, sf_dir):
    m = model(spark, sf_dir)
    return A.monthly_volume_trimmed(m.fact_orders, m.dim_date, TRIM_START, TRIM_END)


def _fold_sql(grid: str) -> str:
    """Recursive twin of forecast._holt_pass: the same state, the same
    operation order, one row per (grid point, step)."""
    lb, u, v = "(f.l + f.b)", "(f.lu + f.bu)", "(f.lv + f.bv)"
    l2, lu2, lv2 = (f"(f.alpha * s.y + (1 - f.alpha) * {lb})", f"((1 - f.alpha) * {u})",
                    f"((1 - f.alpha) * {v})")
    r = f"(s.y - {lb})"
    return f"""
SELECT gi, gj, alpha, beta, 0 AS t, CAST(0 AS DOUBLE) AS l, CAST(0 AS DOUBLE) AS b,
       CAST(1 AS DOUBLE) AS lu, CAST(0 AS DOUBLE) AS bu, CAST(0 AS DOUBLE) AS lv, CAST(1 AS DOUBLE) AS bv,
       CAST(0 AS DOUBLE) AS suu, CAST(0 AS DOUBLE) AS suv, CAST(0 AS DOUBLE) AS svv,
       CAST(0 AS DOUBLE) AS sur, CAST(0 AS DOUBLE) AS svr, CAST(0 AS DOUBLE) AS srr
FROM {grid}
UNION ALL
SELECT f.gi, f.gj, f.alpha, f.beta, f.t + 1,
       {l2}, f.beta * ({l2} - f.l) + (1 - f.beta) * f.b,
       {lu2}, f.beta * ({lu2} - f.lu) + (1 - f.beta) * f.bu,
       {lv2}, f.beta * ({lv2} - f.lv) + (1 - f.beta) * f.bv,
       f.suu + {u} * {u}, f.suv + {u} * {v}, f.svv + {v} * {v},
       f.sur + {u} * {r}, f.svr + {v} * {r}, f.srr + {r} * {r}
FROM FOLD f JOIN _hs_series s ON s.i = f.t"""


def _finish_sql(fold: str) -> str:
    det = "(suu * svv - suv * suv)"
    l0 = f"((svv * sur - suv * svr) / NULLIF({det}, 0))"
    b0 = f"((suu * svr - suv * sur) / NULLIF({det}, 0))"
    sse = (f"(srr - 2 * ({l0} * sur + {b0} * svr) + {l0} * {l0} * suu + 2 * {l0} * {b0} * suv "
           f"+ {b0} * {b0} * svv)")
    return f"""
SELECT gi, gj, alpha, beta, {sse} AS sse, l + {l0} * lu + {b0} * lv AS level,
       b + {l0} * bu + {b0} * bv AS trend
FROM {fold} WHERE t = (SELECT count(*) FROM _hs_series)"""


_HOLT_FIT_CTES = {
    "_hs_series": f"""SELECT year_month, CAST(COUNT(*) AS DOUBLE) AS y,
                             row_number() OVER (ORDER BY year_month) - 1 AS i
                      FROM _fym WHERE year_month BETWEEN '{TRIM_START}' AND '{TRIM_END}'
                      GROUP BY year_month""",
    "_g1": """SELECT a.i AS gi, b.j AS gj, CAST(a.i AS DOUBLE) / CAST(100 AS DOUBLE) AS alpha,
                     CAST(b.j AS DOUBLE) / CAST(100 AS DOUBLE) AS beta
              FROM range(1, 101) a(i), range(0, 101) b(j) WHERE b.j <= a.i""",
    "_f1": _fold_sql("_g1").replace("FOLD", "_f1"),
    "_best1": f"""SELECT * FROM ({_finish_sql('_f1')}) WHERE sse IS NOT NULL
                  ORDER BY sse, alpha, beta LIMIT 1""",
    "_g2": """SELECT ai AS gi, bi AS gj, CAST(ai AS DOUBLE) / CAST(1000 AS DOUBLE) AS alpha,
                     CAST(bi AS DOUBLE) / CAST(1000 AS DOUBLE) AS beta
              FROM (SELECT CAST(round(b.alpha * 1000) AS INTEGER) + i.i AS ai,
                           CAST(round(b.beta * 1000) AS INTEGER) + j.j AS bi
                    FROM _best1 b, range(-10, 11) i(i), range(-10, 11) j(j))
              WHERE ai >= 1 AND ai <= 1000 AND bi >= 0 AND bi <= ai""",
    "_f2": _fold_sql("_g2").replace("FOLD", "_f2"),
    "_best2": f"""SELECT * FROM ({_finish_sql('_f2')}) WHERE sse IS NOT NULL
                  ORDER BY sse, alpha, beta LIMIT 1""",
}


@query("holt_forecast", f"""
SELECT strftime(CAST((SELECT max(year_month) FROM _hs_series) || '-01' AS DATE)
                + to_months(CAST(k.h AS INTEGER)), '%Y-%m') AS year_month,
       CAST(round_even(f.level + k.h * f.trend, 0) AS BIGINT) AS forecasted_order_count
FROM _best2 f, (SELECT unnest(range(1, {HORIZON + 1})) AS h) k""", _HOLT_FIT_CTES, recursive=True)
def q_holt_forecast(spark, sf_dir):
    """FC2: least-squares Holt fit (grid + refinement) on the trimmed series."""
    return H.holt_forecast(_trimmed(spark, sf_dir), HORIZON)


def _dbl(x):
    return f"CAST({x} AS DOUBLE)"


_A, _B = _dbl(FIXED_ALPHA), _dbl(FIXED_BETA)
_L2 = f"({_A} * s.y + ({_dbl(1)} - {_A}) * (h.l + h.b))"


@query("holt_forecast_fixed", f"""
SELECT strftime(CAST(f.last_period || '-01' AS DATE) + to_months(CAST(k.h AS INTEGER)), '%Y-%m') AS year_month,
       CAST(round_even(f.l + k.h * f.b, 0) AS BIGINT) AS forecasted_order_count
FROM (SELECT h.l, h.b, (SELECT max(year_month) FROM _hs_series) AS last_period
      FROM _hs h WHERE h.i = (SELECT count(*) FROM _hs_series)) f,
     (SELECT unnest(range(1, {HORIZON + 1})) AS h) k""", {
    "_hs_series": f"""SELECT year_month, CAST(COUNT(*) AS DOUBLE) AS y,
                             row_number() OVER (ORDER BY year_month) - 1 AS i
                      FROM _fym WHERE year_month BETWEEN '{TRIM_START}' AND '{TRIM_END}'
                      GROUP BY year_month""",
    "_hs": f"""SELECT 0 AS i, max(CASE WHEN i = 0 THEN y END) AS l,
                      max(CASE WHEN i = 1 THEN y END) - max(CASE WHEN i = 0 THEN y END) AS b
               FROM _hs_series HAVING count(*) >= 2
               UNION ALL
               SELECT h.i + 1, {_L2},
                      {_B} * ({_L2} - h.l) + ({_dbl(1)} - {_B}) * h.b
               FROM _hs h JOIN _hs_series s ON s.i = h.i""",
}, recursive=True)
def q_holt_forecast_fixed(spark, sf_dir):
    """FC3: fixed smoothing, l0 = y0, b0 = y1 - y0."""
    fit = H.holt_fixed_fit(_trimmed(spark, sf_dir), FIXED_ALPHA, FIXED_BETA)
    return H.forecast_rows(fit, (), HORIZON)


@query("recent_volume", f"""
SELECT year_month, COUNT(*) AS order_count FROM _fym
WHERE year_month BETWEEN '{TRIM_START}' AND '{TRIM_END}'
GROUP BY year_month ORDER BY year_month DESC LIMIT 6""")
def q_recent_volume(spark, sf_dir):
    return H.recent_periods(_trimmed(spark, sf_dir), 6)


@query("volume_with_forecast", f"""
SELECT year_month, CAST(y AS BIGINT) AS order_count, 'actual' AS kind FROM _hs_series
UNION ALL
SELECT strftime(CAST((SELECT max(year_month) FROM _hs_series) || '-01' AS DATE)
                + to_months(CAST(k.h AS INTEGER)), '%Y-%m'),
       CAST(round_even(f.level + k.h * f.trend, 0) AS BIGINT), 'forecast'
FROM _best2 f, (SELECT unnest(range(1, {HORIZON + 1})) AS h) k""", _HOLT_FIT_CTES, recursive=True)
def q_volume_with_forecast(spark, sf_dir):
    t = _trimmed(spark, sf_dir)
    return H.volume_with_forecast(t, H.holt_forecast(t, HORIZON))


# ------------------------------------------------------------------ findings
_STAGES = {"p": G.STAGE_PROCESSING, "c": G.STAGE_PICKUP, "s": G.STAGE_SHIPPING}
_DOM = (f"CASE WHEN p >= c AND p >= s THEN {_sq(G.STAGE_PROCESSING)} "
        f"WHEN c >= s THEN {_sq(G.STAGE_PICKUP)} ELSE {_sq(G.STAGE_SHIPPING)} END")


def _narrative_sql():
    parts = {"seller": "seller_id", "delay": FMT("avg_delay_days", 1),
             "orders": "CAST(order_count AS VARCHAR)", "z": FMT("coalesce(z, 0.0)", 2),
             "stage": "dominant_stage", "stage_days": FMT("sd", 1), "proc": FMT("p", 1),
             "ship": FMT("s", 1)}
    out, rest = [], G.NARRATIVE
    while "{" in rest:
        pre, _, tail = rest.partition("{")
        key, _, rest = tail.partition("}")
        out += [_sq(pre), parts[key]]
    out.append(_sq(rest))
    return " || ".join(out)


_SRC = f"[{FMT('p', 1)}, {FMT('c', 1)}, {FMT('s', 1)}, {FMT('avg_delay_days', 1)}, " \
       f"CASE WHEN z IS NOT NULL THEN {FMT('z', 2)} END]"


def _findings_ctes(sellers_sql: str) -> dict:
    return {
        **_Z,
        "_rc": _ROOT_CAUSE_SQL,
        "_fl": sellers_sql,
        "_st": """SELECT r.*, f.z, coalesce(r.avg_processing_days, 0.0) AS p,
                         coalesce(r.avg_carrier_pickup_days, 0.0) AS c,
                         coalesce(r.avg_shipping_days, 0.0) AS s
                  FROM _rc r JOIN _fl f ON r.seller_id = f.seller_id""",
        "_dom": f"SELECT *, {_DOM} AS dominant_stage FROM _st",
        "_sd": f"""SELECT *, CASE dominant_stage WHEN {_sq(G.STAGE_PROCESSING)} THEN p
                                 WHEN {_sq(G.STAGE_PICKUP)} THEN c ELSE s END AS sd FROM _dom""",
        "_nar": f"SELECT *, {_narrative_sql()} AS narrative FROM _sd",
        "_bad": f"""SELECT *, list_sort(list_filter(list_distinct(regexp_extract_all(narrative, '-?\\d+\\.\\d+')),
                                               lambda x: NOT list_contains({_SRC}, x))) AS bad FROM _nar""",
        "_fnd": f"""SELECT seller_id, CAST(order_count AS INTEGER) AS order_count,
                    {R('avg_delay_days')} AS avg_delay_days, {R('coalesce(z, 0.0)')} AS z_score,
                    dominant_stage,
                    MAP {{{_sq(G.STAGE_PROCESSING)}: p, {_sq(G.STAGE_PICKUP)}: c,
                          {_sq(G.STAGE_SHIPPING)}: s}} AS stage_breakdown,
                    narrative,
                    CASE dominant_stage WHEN {_sq(G.STAGE_PICKUP)} THEN {_sq(G.RECOMMENDATION[G.STAGE_PICKUP])}
                         WHEN {_sq(G.STAGE_SHIPPING)} THEN {_sq(G.RECOMMENDATION[G.STAGE_SHIPPING])}
                         ELSE {_sq(G.RECOMMENDATION[G.STAGE_PROCESSING])} END AS recommendation,
                    len(bad) = 0 AS grounded,
                    CASE WHEN len(bad) = 0 THEN {_sq(G.GROUNDED_NOTE)}
                         ELSE {_sq(G.UNGROUNDED_NOTE)} || '{{' ||
                              array_to_string(list_transform(bad, lambda x: '''' || x || ''''), ', ')
                              || '}}' END AS grounding_notes
                    FROM _bad""",
    }


_FLAGGED_TOP5 = "SELECT seller_id, z FROM _z WHERE is_anomalous ORDER BY z DESC NULLS LAST, seller_id LIMIT 5"


@query("seller_findings", "SELECT * FROM _fnd", _findings_ctes(_FLAGGED_TOP5))
def q_seller_findings(spark, sf_dir):
    """AG7: findings for the top-5 flagged sellers."""
    return G.seller_findings(model(spark, sf_dir).fact_orders, top_n=5)


@query("groundedness", "SELECT seller_id, narrative, grounded, grounding_notes FROM _fnd",
       _findings_ctes("SELECT seller_id, z FROM _z"))
def q_groundedness(spark, sf_dir):
    """AG5 on every z-scored seller (flagged or not)."""
    f = model(spark, sf_dir).fact_orders
    z = S.seller_zscore(f)
    return G.investigate(f, z).select("seller_id", "narrative", "grounded", "grounding_notes")


@query("dominant_stage", f"""
SELECT seller_id, avg_processing_days, avg_carrier_pickup_days, avg_shipping_days, {_DOM} AS dominant_stage
FROM (SELECT *, coalesce(avg_processing_days, 0.0) AS p, coalesce(avg_carrier_pickup_days, 0.0) AS c,
             coalesce(avg_shipping_days, 0.0) AS s FROM ({_ROOT_CAUSE_SQL}))""")
def q_dominant_stage(spark, sf_dir):
    rc = A.root_cause_breakdown(model(spark, sf_dir).fact_orders)
    return rc.select("seller_id", "avg_processing_days", "avg_carrier_pickup_days", "avg_shipping_days",
                     G.dominant_stage(F.col("avg_processing_days"), F.col("avg_carrier_pickup_days"),
                                      F.col("avg_shipping_days")).alias("dominant_stage"))


def _body(name):
    from .registry import ORACLE_BODY
    return ORACLE_BODY[name]


# ------------------------------------------------------------------ dashboard
def _monthly(spark, sf_dir):
    m = model(spark, sf_dir)
    return A.monthly_kpis(m.fact_orders, m.dim_date)


@query("monthly_trend", "SELECT * FROM _mk WHERE total_orders >= 100", {"_mk": _MONTHLY_SQL})
def q_monthly_trend(spark, sf_dir):
    return P.monthly_trend(_monthly(spark, sf_dir))


@query("headline_kpis", f"""
SELECT l.year_month AS latest_month, l.on_time_pct,
       {R('coalesce(l.on_time_pct, 0.0) - coalesce(p.on_time_pct, 0.0)', 1)} AS delta_on_time_pts,
       l.avg_delay_days, l.total_orders, l.avg_review_score,
       d.rate AS dq_pass_rate, d.flagged AS dq_flagged
FROM (SELECT * FROM _l2 ORDER BY year_month DESC LIMIT 1) l,
     (SELECT * FROM _l2 ORDER BY year_month ASC LIMIT 1) p,
     (SELECT {R('CAST(100.0 AS DOUBLE) * AVG(passed)', 1)} AS rate,
             COUNT(*) FILTER (WHERE passed = 0) AS flagged FROM {_ALL_DQ}) d""", {
    "_mk": _MONTHLY_SQL,
    "_l2": "SELECT * FROM _mk WHERE total_orders >= 100 ORDER BY year_month DESC LIMIT 2",
})
def q_headline_kpis(spark, sf_dir):
    return P.headline_kpis(_monthly(spark, sf_dir), dq_results(spark, sf_dir))


@query("worst_sellers", """
SELECT seller_id, seller_state, order_count, on_time_pct, avg_delay_days, avg_review_score
FROM _sc ORDER BY on_time_pct ASC NULLS LAST, seller_id LIMIT 15""", {
    "_sc": _body("seller_scorecard")})
def q_worst_sellers(spark, sf_dir):
    m = model(spark, sf_dir)
    return P.worst_sellers(A.seller_measures(m.fact_orders, m.dim_seller))


@query("worst_states", """
SELECT * FROM _sp ORDER BY on_time_pct ASC NULLS LAST, customer_state LIMIT 15""", {
    "_sp": _body("state_performance")})
def q_worst_states(spark, sf_dir):
    m = model(spark, sf_dir)
    return P.worst_states(A.state_performance(m.fact_orders, m.dim_customer))


# ------------------------------------------------------- runner and pipeline
_ANALYTICS = [("01_monthly_kpis", "monthly_kpis"), ("02_seller_scorecard", "seller_scorecard"),
              ("03_state_performance", "state_performance"),
              ("04_anomaly_detection", "seller_month_anomalies"),
              ("06_payment_vs_outcome", "payment_vs_outcome")]




@query("run_all_analytics", "\nUNION ALL\n".join(
    f"SELECT {_sq(label)} AS query_name, (SELECT COUNT(*) FROM ({_body(name)})) AS row_count"
    for label, name in _ANALYTICS))
def q_run_all_analytics(spark, sf_dir):
    """SRC5: every non-parameterized analytics query, with its row count."""
    from .registry import QUERIES
    parts = [QUERIES[name](spark, sf_dir).agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(label).alias("query_name"), "row_count") for label, name in _ANALYTICS]
    return reduce(DataFrame.unionByName, parts)


@query("sql_root_cause_one_seller", f"""
SELECT * FROM ({_ROOT_CAUSE_SQL})
WHERE seller_id = (SELECT min(seller_id) FROM fact_orders WHERE n_sellers = 1)""")
def q_sql_root_cause_one_seller(spark, sf_dir):
    """FLT3: the seller query with its bound parameter, for the first seller by id."""
    m = model(spark, sf_dir)
    first = m.fact_orders.filter("n_sellers = 1").agg(F.min("seller_id")).first()[0]
    return run_query(spark, m, "root_cause_breakdown", {"seller_id": first})


def _register_sql(name):
    @query(f"sql_{name}", _body(name))
    def run(spark, sf_dir):
        return run_query(spark, model(spark, sf_dir), name)
    run.__doc__ = f"SRC5: the SQL file {name}.sql."


for _, _name in _ANALYTICS:
    _register_sql(_name)


_RUNS: dict = {}
_RUN_LOCK = threading.Lock()


def pipeline_run(spark, sf_dir):
    """(root, log) of one four-stage job on the adapted raw model, run once per
    application and input folder; its stored tables serve several queries. The job stores
    the raw layer itself, so it takes the adapter's tables as they are planned."""
    key = (app_id(spark), sf_dir.rstrip("/"))
    with _RUN_LOCK:
        if key not in _RUNS:
            _RUNS[key] = run_pipeline(spark, raw_model(spark, sf_dir), run_ts=REPORT_TS)
        return _RUNS[key]


_RAW_NAMES = ["raw_orders", "raw_order_items", "raw_order_payments", "raw_order_reviews", "raw_customers",
              "raw_sellers", "raw_products", "raw_geolocation", "raw_category_translation"]
_MODEL_NAMES = ["dim_date", "dim_geography", "dim_customer", "dim_seller", "dim_product", "fact_order_items", "fact_orders"]


def _total(names):
    return "(SELECT sum(n) FROM (" + " UNION ALL ".join(f"SELECT count(*) AS n FROM {n}" for n in names) + "))::BIGINT"


@query("run_pipeline", f"""
SELECT 'ingest' AS stage, 'OK' AS status, {_total(_RAW_NAMES)} AS counted, NULL::BIGINT AS flagged
UNION ALL SELECT 'validate_raw', 'OK', count(*), count(*) FILTER (passed = 0) FROM {_ALL_DQ} WHERE layer = 'raw'
UNION ALL SELECT 'transform_load', 'OK', {_total(_MODEL_NAMES)}, NULL
UNION ALL SELECT 'validate_modeled', CASE WHEN min(passed) = 0 THEN 'DEGRADED' ELSE 'OK' END, count(*),
                 count(*) FILTER (passed = 0) FROM {_ALL_DQ} WHERE layer = 'modeled'
UNION ALL SELECT 'pipeline', 'SUCCESS', NULL, NULL""")
def q_run_pipeline(spark, sf_dir):
    """PL1: the stages of a run as its log has them: status, rows or checks counted,
    checks flagged."""
    _, log = pipeline_run(spark, sf_dir)
    digits = F.regexp_extract("detail", r"^([\d,]+) ", 1)
    flagged = F.regexp_extract("detail", r", (\d+) (?:flagged|failed)", 1)
    return log.frame().select("stage", "status", F.translate(digits, ",", "").try_cast("bigint").alias("counted"),
                              flagged.try_cast("bigint").alias("flagged"))


@query("pipeline_run_log", """
SELECT stage, 1::BIGINT AS entries, 1::BIGINT AS dated, row_number() OVER () AS place
FROM (VALUES ('ingest'), ('validate_raw'), ('transform_load'), ('validate_modeled'), ('pipeline')) AS stages(stage)""")
def q_pipeline_run_log(spark, sf_dir):
    """SNK4: the JSON-lines run log as written: one dated entry per stage, in order."""
    _, log = pipeline_run(spark, sf_dir)
    per = log.frame().groupBy("stage").agg(F.count(F.lit(1)).alias("entries"), F.count("ts").alias("dated"), F.min("ts").alias("t"))
    return per.select("stage", "entries", "dated", F.row_number().over(Window.orderBy("t")).cast("bigint").alias("place"))


@query("pipeline_dq_results", f"SELECT * FROM {_ALL_DQ}")
def q_pipeline_dq_results(spark, sf_dir):
    """SNK2/SNK3: the stored results table of a pipeline run, after its modeled
    validation was run a second time (a partition is replaced, not appended to)."""
    root, _ = pipeline_run(spark, sf_dir)
    m = TableModel(spark, f"{root}/model")
    with shuffles_dropped(spark):
        write_dq(Q.modeled_checks(m, spark.read.parquet(f"{root}/raw/raw_orders"), REPORT_TS), root, "modeled")
    return spark.read.parquet(f"{root}/data_quality_results").select(*Q.RESULT_COLS)


_SNAPSHOT_SQL = " UNION ALL ".join(
    f"SELECT {_sq(layer)} AS layer, {_sq(n)} AS name, count(*) AS row_count, {str(n in ('raw_sellers', 'dim_seller')).lower()} "
    f"AS rewritten FROM {n}" for layer, names in (("raw", _RAW_NAMES), ("model", _MODEL_NAMES)) for n in names)


@query("pipeline_snapshot", _SNAPSHOT_SQL)
def q_pipeline_snapshot(spark, sf_dir):
    """SNK1/PL1 on versioned snapshots: the tables of the second of two runs, between
    which the sellers changed, and which of them it wrote."""
    root = scratch_path(spark, "snapshots", app_id(spark), uuid.uuid4().hex)
    raw = raw_model(spark, sf_dir)
    old, _ = run_snapshot(spark, raw, root, REPORT_TS)
    changed = {**dict(raw.items()), "raw_sellers": raw["raw_sellers"].withColumn("seller_city", F.upper(F.concat("seller_city", F.lit("!"))))}
    new, _ = run_snapshot(spark, changed, root, REPORT_TS)
    parts = [spark.read.parquet(folder).agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(layer).alias("layer"), F.lit(n).alias("name"), "row_count", F.lit(folder != old.tables[layer, n][0]).alias("rewritten"))
        for (layer, n), (folder, _) in new.tables.items() if layer != "dq"]
    return reduce(DataFrame.unionByName, parts)


# ------------------------------------------------------------------ CSV ingest
_INGESTS: dict = {}
_EXPORT_ROWS = 1_000_000


def csv_round_trip(spark, sf_dir):
    """The raw layer that ingest makes of the adapter tables exported to CSV, built
    once per application and input folder. The export is text of four times the input's
    bytes, so it is compressed, in files short enough for a task each."""
    key = (app_id(spark), sf_dir.rstrip("/"))
    with _RUN_LOCK:
        if key not in _INGESTS:
            root = scratch_path(spark, "csv", app_id(spark), uuid.uuid4().hex)
            with shuffles_dropped(spark):
                write_csv(raw_model(spark, sf_dir), f"{root}/source", "gzip", _EXPORT_ROWS)
            ingest_csv(spark, f"{root}/source", f"{root}/raw")
            _INGESTS[key] = f"{root}/raw"
        return read_raw_layer(spark, _INGESTS[key])


@query("csv_ingest_orders", "SELECT * FROM raw_orders")
def q_csv_ingest_orders(spark, sf_dir):
    """SRC1/PRJ3: orders exported to CSV, landed as text and typed again."""
    return csv_round_trip(spark, sf_dir)["raw_orders"]


@query("csv_ingest_items", "SELECT * FROM raw_order_items")
def q_csv_ingest_items(spark, sf_dir):
    return csv_round_trip(spark, sf_dir)["raw_order_items"].drop("_seq")


@query("csv_ingest_counts", " UNION ALL ".join(
    f"SELECT {_sq(n)} AS table_name, count(*) AS row_count FROM {n}" for n in _RAW_NAMES))
def q_csv_ingest_counts(spark, sf_dir):
    return row_counts(csv_round_trip(spark, sf_dir))


_EXPORT_FILES, _EXPORT_SPLIT = 7, "64k"


def many_file_export(spark, sf_dir):
    """Payments exported as several CSV files, in the order of order and position,
    with columns beyond the contract: a note over several quoted lines, a whole number,
    one with gaps, a fraction, a date, a truth value and a mixed column. Ingested once
    per application and input folder with splits far smaller than a file, so that
    records lie across them."""
    key = (app_id(spark), sf_dir.rstrip("/"), "many")
    with _RUN_LOCK:
        if key not in _INGESTS:
            root = scratch_path(spark, "csv", app_id(spark), uuid.uuid4().hex)
            k = F.col("order_id").cast("bigint")
            p = raw_model(spark, sf_dir)["raw_order_payments"].select(
                "*", F.concat(F.lit('note "'), "order_id", F.lit('",\nof '), F.col("payment_type"), F.lit("\n")).alias("note"),
                k.alias("whole"), F.when(k % 3 != 0, k).alias("gaps"), (k / 4).alias("fraction"),
                F.date_add(F.lit("2020-01-01").cast("date"), (k % 1000).cast("int")).cast("string").alias("day"),
                F.when(k % 2 == 0, "True").otherwise("False").alias("even"),
                F.when(k % 5 == 0, "five").otherwise(k.cast("string")).alias("mixed"))
            with shuffles_dropped(spark):
                (p.repartitionByRange(_EXPORT_FILES, k).sortWithinPartitions(k, "payment_sequential").write.option("header", True)
                 .option("escape", '"').option("emptyValue", "").option("quoteAll", True).option("ignoreLeadingWhiteSpace", False)
                 .option("ignoreTrailingWhiteSpace", False).csv(f"{root}/payments"))
                written: list = []
                text = read_csv_text(spark, f"{root}/payments", "raw_order_payments", written, _EXPORT_SPLIT)
                text.write.option("compression", "zstd").parquet(f"{root}/text")
                drop_folders(spark, written)
                text = spark.read.parquet(f"{root}/text")
                types = infer_types(text, extra_columns(text, "raw_order_payments"))
                type_raw(text, "raw_order_payments", types).write.parquet(f"{root}/typed")
            _INGESTS[key] = f"{root}/typed"
        return spark.read.parquet(_INGESTS[key])


@query("csv_many_files", r"""
SELECT order_id, payment_sequential, payment_type, payment_installments, payment_value,
       'note "' || order_id || '",' || chr(10) || 'of ' || payment_type || chr(10) AS note,
       order_id::BIGINT AS whole, CASE WHEN order_id::BIGINT % 3 <> 0 THEN order_id::DOUBLE END AS gaps,
       order_id::BIGINT / 4.0::DOUBLE AS fraction,
       strftime(DATE '2020-01-01' + (order_id::BIGINT % 1000)::INTEGER, '%Y-%m-%d') AS day, order_id::BIGINT % 2 = 0 AS even,
       CASE WHEN order_id::BIGINT % 5 = 0 THEN 'five' ELSE order_id END AS mixed,
       row_number() OVER (ORDER BY order_id::BIGINT, payment_sequential) AS place
FROM raw_order_payments""")
def q_csv_many_files(spark, sf_dir):
    """SRC1/DED1: several files with quoted line breaks, read in splits: every cell
    with its inferred type, and every record's place in the order of the files."""
    df = many_file_export(spark, sf_dir)
    return global_rank(df, "_seq", "place", write_input=False).drop("_seq")


# ----------------------------------------------------------- forecast per key
_STATE_SERIES = f"""
SELECT CASE WHEN state NOT LIKE 'A%' THEN state END AS state, year_month, count(*) AS order_count
FROM _fym JOIN dim_customer USING (customer_id)
WHERE year_month BETWEEN '{TRIM_START}' AND '{TRIM_END}' GROUP BY ALL
UNION ALL SELECT 'one month only', '{TRIM_START}', 7"""


def _state_series(spark, sf_dir):
    """Monthly orders per customer state; states that begin with A go to a NULL
    key, and one key has a single month."""
    m = model(spark, sf_dir)
    state = F.when(~F.col("state").startswith("A"), F.col("state"))
    f = m.fact_orders.join(merged(m.dim_customer.select("customer_id", state.alias("state"))), "customer_id")
    s = A.monthly_volume_trimmed(f, m.dim_date, TRIM_START, TRIM_END, keys=["state"])
    short = spark.range(1).select(F.lit("one month only").alias("state"), F.lit(TRIM_START).alias("year_month"),
                                  F.lit(7).cast("bigint").alias("order_count"))
    return s.unionByName(short)


@query("holt_forecast_by_state", f"""
SELECT state, strftime(CAST(last_period || '-01' AS DATE) + to_months(CAST(k.h AS INTEGER)), '%Y-%m') AS year_month,
       CASE WHEN n >= 2 THEN CAST(round_even(l + k.h * b, 0) AS BIGINT) END AS forecasted_order_count
FROM (SELECT h.key, h.l, h.b, s.state, s.last_period, s.n
      FROM _kh h JOIN (SELECT key, any_value(state) AS state, max(year_month) AS last_period, count(*) AS n
                       FROM _ks GROUP BY key) s ON h.key = s.key AND h.i = s.n) f,
     (SELECT unnest(range(1, {HORIZON + 1})) AS h) k""", {
    "_ks": f"""SELECT state, coalesce(state, '-') AS key, year_month, CAST(order_count AS DOUBLE) AS y,
                      row_number() OVER (PARTITION BY state ORDER BY year_month) - 1 AS i FROM ({_STATE_SERIES})""",
    "_kh": f"""SELECT key, 0 AS i, max(CASE WHEN i = 0 THEN y END) AS l,
                      coalesce(max(CASE WHEN i = 1 THEN y END), 0) - max(CASE WHEN i = 0 THEN y END) AS b
               FROM _ks GROUP BY key
               UNION ALL
               SELECT h.key, h.i + 1, {_L2}, {_B} * ({_L2} - h.l) + ({_dbl(1)} - {_B}) * h.b
               FROM _kh h JOIN _ks s ON s.key = h.key AND s.i = h.i""",
}, recursive=True)
def q_holt_forecast_by_state(spark, sf_dir):
    """FC3 per key, a NULL key and a key of one month included."""
    fit = H.holt_fixed_fit(_state_series(spark, sf_dir), FIXED_ALPHA, FIXED_BETA, ["state"])
    return H.forecast_rows(fit, ["state"], HORIZON)


def _keyed(sql: str) -> str:
    """A fold or its finish over one grid as one over the grids of all keys."""
    return (sql.replace("SELECT gi,", "SELECT key, gi,").replace("SELECT f.gi,", "SELECT f.key, f.gi,")
            .replace("JOIN _hs_series s ON s.i = f.t", "JOIN _ks s ON s.key = f.key AND s.i = f.t"))


def _best_of(fold: str) -> str:
    finish = _keyed(_finish_sql(fold)).replace("t = (SELECT count(*) FROM _hs_series)",
                                               f"t = (SELECT count(*) FROM _ks WHERE _ks.key = {fold}.key)")
    return f"""SELECT * FROM ({finish}) WHERE sse IS NOT NULL
               QUALIFY row_number() OVER (PARTITION BY key ORDER BY sse, alpha, beta) = 1"""


_STATE_FIT_CTES = {
    "_ks": f"""SELECT state, coalesce(state, '-') AS key, year_month, CAST(order_count AS DOUBLE) AS y,
                      row_number() OVER (PARTITION BY state ORDER BY year_month) - 1 AS i FROM ({_STATE_SERIES})""",
    "_kg1": """SELECT k.key, a.i AS gi, b.j AS gj, CAST(a.i AS DOUBLE) / CAST(100 AS DOUBLE) AS alpha,
                      CAST(b.j AS DOUBLE) / CAST(100 AS DOUBLE) AS beta
               FROM (SELECT DISTINCT key FROM _ks) k, range(1, 101) a(i), range(0, 101) b(j) WHERE b.j <= a.i""",
    "_kf1": _keyed(_fold_sql("_kg1")).replace("FOLD", "_kf1"),
    "_kb1": _best_of("_kf1"),
    "_kg2": """SELECT key, ai AS gi, bi AS gj, CAST(ai AS DOUBLE) / CAST(1000 AS DOUBLE) AS alpha,
                      CAST(bi AS DOUBLE) / CAST(1000 AS DOUBLE) AS beta
               FROM (SELECT b.key, CAST(round(b.alpha * 1000) AS INTEGER) + i.i AS ai,
                            CAST(round(b.beta * 1000) AS INTEGER) + j.j AS bi
                     FROM _kb1 b, range(-10, 11) i(i), range(-10, 11) j(j))
               WHERE ai >= 1 AND ai <= 1000 AND bi >= 0 AND bi <= ai""",
    "_kf2": _keyed(_fold_sql("_kg2")).replace("FOLD", "_kf2"),
    "_kb2": _best_of("_kf2"),
}


@query("forecast_fit_keys", """
SELECT s.state, s.last_period, s.n >= 2 AS fitted, b.alpha, b.beta, b.level, b.trend
FROM (SELECT state, key, max(year_month) AS last_period, count(*) AS n FROM _ks GROUP BY state, key) s
LEFT JOIN _kb2 b ON b.key = s.key""", _STATE_FIT_CTES, recursive=True)
def q_forecast_fit_keys(spark, sf_dir):
    """FC2 per key: every key has a row after the refined fit on the full grid, with
    the parameters and the final state found for it."""
    fit = H.holt_fit(_state_series(spark, sf_dir), ["state"])
    return fit.select("state", "last_period", F.col("level").isNotNull().alias("fitted"), "alpha", "beta", "level", "trend")


@query("forecast_fit_iterative", f"""
SELECT state, max(year_month) AS last_period, count(*) >= 2 AS fitted, CASE WHEN count(*) >= 2 THEN true END AS no_worse
FROM ({_STATE_SERIES}) GROUP BY state""")
def q_forecast_fit_iterative(spark, sf_dir):
    """FC2 per key by iterative least squares: is its sum of squares no larger than the
    refined grid's (but for rounding)?"""
    series = _state_series(spark, sf_dir)
    grid = H.holt_fit(series, ["state"]).select(F.col("state").alias("_s"), F.col("sse").alias("grid"))
    fit = H.holt_fit_iterative(series, ["state"])
    j = fit.join(grid, fit["state"].eqNullSafe(grid["_s"]))
    slack = F.lit(1e-9) * F.col("grid") + F.lit(1e-6)
    return j.select("state", "last_period", F.col("level").isNotNull().alias("fitted"),
                    (F.col("sse") <= F.col("grid") + slack).alias("no_worse"))


@query("volume_without_gaps", f"""
SELECT k.state, strftime(k.m, '%Y-%m') AS year_month, coalesce(s.order_count, 0) AS order_count
FROM (SELECT state, unnest(generate_series(min((year_month || '-01')::DATE)::TIMESTAMP,
                                           max((year_month || '-01')::DATE)::TIMESTAMP, INTERVAL 1 MONTH)) AS m
      FROM ({_STATE_SERIES}) GROUP BY state) k
LEFT JOIN ({_STATE_SERIES}) s ON s.state IS NOT DISTINCT FROM k.state AND s.year_month = strftime(k.m, '%Y-%m')""")
def q_volume_without_gaps(spark, sf_dir):
    return H.fill_gaps(_state_series(spark, sf_dir), ["state"])
