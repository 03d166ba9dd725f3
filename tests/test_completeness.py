"""Nothing is cut, lost or silently changed: ingest, checks, SQL files, forecasts."""

import os
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from parcelyze.operators import analytics as A
from parcelyze.operators import forecast as H
from parcelyze.operators import quality as Q
from parcelyze.plans import sql_runner
from parcelyze.plans.pipeline import run_pipeline
from parcelyze.plans.registry import dirty_model, model
from parcelyze.sources import ingest

from .conftest import SF001
from .test_ingest_pipeline import _write_csvs


def plan(df):
    return df._jdf.queryExecution().toString()


# --------------------------------------------------------------------- ingest
def sources(**changed):
    d = tempfile.mkdtemp(prefix="pz-csv-")
    _write_csvs(d, "o1,c1,delivered,2018-01-02 10:00:00,2018-01-02,garbage,,2018-01-20 00:00:00\n")
    for name, text in changed.items():
        with open(os.path.join(d, ingest.CSV_FILES[name]), "w") as f:
            f.write(text)
    return d, tempfile.mkdtemp(prefix="pz-raw-")


def test_values_are_not_altered_and_bad_cells_are_listed(spark):
    src, out = sources(
        raw_order_reviews="review_id,order_id,review_score,comment\nr1,o1,4.7,x\nr2,o2,4.0,y\nr3,o3, 3 ,z\nr4,o4,five, NA \n",
        raw_customers="customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state,extra\n"
                      "c1, NA ,01037,  sao paulo ,SP,more\n")
    ingest.ingest_csv(spark, src, out)
    raw = ingest.read_raw_layer(spark, out)
    reviews = {r["order_id"]: r for r in raw["raw_order_reviews"].collect()}
    assert [reviews[o]["review_score"] for o in ("o1", "o2", "o3", "o4")] == [None, 4, 3, None]
    assert reviews["o1"]["review_id"] == "r1" and reviews["o4"]["comment"] == " NA "      # kept beyond the contract
    c = raw["raw_customers"].first()
    assert (c["customer_unique_id"], c["customer_city"], c["customer_zip_code_prefix"], c["extra"]) == (
        " NA ", "  sao paulo ", 1037, "more")
    bad = {(r["table_name"], r["column_name"], r["cell"]): r["row_count"] for r in ingest.read_unparsed_cells(spark, out).collect()}
    assert bad == {("raw_order_reviews", "review_score", "4.7"): 1, ("raw_order_reviews", "review_score", "five"): 1,
                   ("raw_orders", "order_approved_at", "2018-01-02"): 1,
                   ("raw_orders", "order_delivered_carrier_date", "garbage"): 1}
    text = spark.read.parquet(f"{out}/_text/raw_order_reviews")
    assert {r["review_score"] for r in text.collect()} == {"4.7", "4.0", " 3 ", "five"}


def test_missing_column_is_an_error_before_anything_is_written(spark):
    src, out = sources(raw_sellers="seller,seller_zip_code_prefix,seller_city,seller_state\n1,2,x,SP\n")
    with pytest.raises(ValueError, match="seller_id"):
        ingest.ingest_csv(spark, src, out)
    assert os.listdir(out) == []


def test_missing_file_on_a_path_without_scheme(spark):
    src, out = sources()
    assert "://" not in src
    os.rename(os.path.join(src, ingest.CSV_FILES["raw_sellers"]), os.path.join(src, "other.csv"))
    with pytest.raises(FileNotFoundError, match="sellers"):
        ingest.ingest_csv(spark, src, out)


def test_unknown_master_needs_a_shared_folder(monkeypatch):
    from parcelyze import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Remote:
        conf = Conf()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Remote())


# --------------------------------------------------------------------- checks
def test_every_check_is_violated_on_the_dirty_model(spark):
    m = dirty_model(spark, "/root/testdata/sf0.01")
    raw = {r["check_id"]: r for r in Q.raw_checks(m.raw, "t").collect()}
    assert sorted(raw) == list(range(1, 13))
    assert all(raw[i]["violations"] > 0 and raw[i]["passed"] == 0 for i in range(1, 12)) and raw[12]["passed"] == 1
    modeled = {r["check_id"]: r for r in Q.modeled_checks(m, m.raw["raw_orders"], "t").collect()}
    assert all(modeled[i]["violations"] > 0 and modeled[i]["passed"] == 0 for i in range(1, 7)) and modeled[7]["violations"] > 0
    assert all(v > 0 for v in Q.sql_check_counts(m).first())
    for layer, ids in (("raw", range(1, 12)), ("modeled", range(1, 6))):
        for i in ids:
            assert Q.violating_rows(layer, i, raw=m.raw, model=m).limit(1).count() == 1, (layer, i)


def test_all_unexpected_statuses_are_listed(spark):
    o = spark.range(100).select(F.format_string("s%03d", "id").alias("order_status"))
    assert Q.unexpected_values(o, "order_status", ["s001"]).count() == 99


def test_raw_checks_read_the_orders_three_times(spark):
    text = Q.raw_checks(model(spark, SF001).raw, "t")._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Relation \[[^\]]*order_status", text)) <= 3


# ------------------------------------------------------------------ SQL files
def test_a_missing_or_unknown_parameter_is_an_error(spark):
    m = model(spark, SF001)
    for params in (None, {}, {"seller_id": None}):
        with pytest.raises(ValueError, match="seller_id"):
            sql_runner.run_query(spark, m, "root_cause_breakdown", params)
    with pytest.raises(ValueError, match="oops"):
        sql_runner.run_query(spark, m, "monthly_kpis", {"oops": 1})
    assert sql_runner.parameters("SELECT :a, ':b', x::int -- :c\n/* :d */ , :e") == {"a", "e"}


class Facts:
    """A model that is one fact table."""

    def __init__(self, df):
        self.fact_orders = df


def test_sql_files_and_operators_round_a_tie_alike(spark):
    seconds = [206064, -1445904, 1691712, 1937952]              # they average exactly 6.915 days
    f = spark.createDataFrame([("card", 1, s / 86400, 5.0) for s in seconds],
                              "payment_type string, payment_installments int, delivery_delay_days double, review_score double")
    a = A.payment_vs_outcome(f).first()
    b = sql_runner.run_query(spark, Facts(f), "payment_vs_outcome").first()
    assert a == b and a["avg_delay_days"] == 6.92


# ------------------------------------------------------------------- forecasts
def series(spark):
    rows = [(k, f"2017-{i:02d}", n) for k, ns in (("a", [5, 7, 9, 12, 15, 16]), (None, [3, 3, 4, 4, 5, 5])) for i, n in enumerate(ns, 1)]
    return spark.createDataFrame(rows + [("short", "2017-03", 4)], "k string, year_month string, order_count long")


@pytest.mark.parametrize("refine", [False, True])
def test_no_key_is_lost(spark, refine):
    got = {r["k"]: r for r in H.holt_fit(series(spark), ["k"], step=0.1, refine=refine).collect()}
    assert set(got) == {"a", None, "short"} and got["short"]["last_period"] == "2017-03"
    assert got["a"]["level"] is not None and got[None]["level"] is not None
    rows = H.holt_forecast(series(spark), 2, ["k"], step=0.1, refine=refine).collect()
    assert len(rows) == 6 and all((r["forecasted_order_count"] is None) == (r["k"] == "short") for r in rows)
    fixed = {r["k"]: r["level"] for r in H.holt_fixed_fit(series(spark), 0.5, 0.1, ["k"]).collect()}
    assert set(fixed) == {"a", None, "short"} and fixed["short"] is None


def test_refined_fit_is_a_least_squares_optimum_on_noise(spark):
    """No nearby smoothing pair or start does better, checked with numpy on noisy data."""
    import numpy as np
    rng = np.random.default_rng(8)
    y = (100 + 5 * np.arange(20) + rng.normal(0, 12, 20)).round()
    s = spark.createDataFrame([(f"2017-{i + 1:02d}" if i < 12 else f"2018-{i - 11:02d}", int(v)) for i, v in enumerate(y)],
                              "year_month string, order_count long")
    fit = H.holt_fit(s, step=0.02).first()

    def sse(a, b):
        m, t = [], []
        for l0, b0 in ((0, 0), (1, 0), (0, 1)):
            level, trend, p = float(l0), float(b0), []
            for v in (y if (l0, b0) == (0, 0) else np.zeros(len(y))):
                p.append(level + trend)
                new = a * v + (1 - a) * (level + trend)
                trend = b * (new - level) + (1 - b) * trend
                level = new
            m.append(p)
        left = np.array(m[1:]).T
        x, *_ = np.linalg.lstsq(left, y - np.array(m[0]), rcond=None)
        return float((((y - np.array(m[0])) - left @ x) ** 2).sum())
    assert fit["sse"] == pytest.approx(sse(fit["alpha"], fit["beta"]), rel=1e-6)
    grid = [(a, b) for a in np.arange(0.01, 1.001, 0.01) for b in np.arange(0, a + 1e-9, 0.01)]
    assert fit["sse"] <= min(sse(a, b) for a, b in grid[::3]) * 1.0005


def test_gaps_are_filled_on_request(spark):
    s = spark.createDataFrame([("a", "2017-11", 2), ("a", "2018-02", 3), (None, "2017-01", 1)],
                              "k string, year_month string, order_count long")
    got = sorted(((r["k"] or "", r["year_month"], r["order_count"]) for r in H.fill_gaps(s, ["k"]).collect()))
    assert got == [("", "2017-01", 1), ("a", "2017-11", 2), ("a", "2017-12", 0), ("a", "2018-01", 0), ("a", "2018-02", 3)]


# ----------------------------------------------------------------- plans, log
def test_failure_is_logged_whole(spark):
    root, message = tempfile.mkdtemp(prefix="pz-run-"), "x" * 5000

    def bad(path):
        raise RuntimeError(message)
    with pytest.raises(RuntimeError):
        run_pipeline(spark, bad, root)
    assert spark.read.json(f"{root}/pipeline_runs").first()["detail"] == message


def test_hot_group_is_dealt_by_group_and_bucket(spark):
    """A third of all geocodes in one zip: after the cut points are joined on (zip,
    salt), an exchange on (zip, bucket) comes before the running sums."""
    from parcelyze.operators.ranking import grouped_exact_quantiles
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("zip"),
                                  (F.col("id") * 7919 % 5000).cast("double").alias("x"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        q = grouped_exact_quantiles(df, ["zip"], "x", [0.5])
        text = plan(q)
        got = {r["zip"]: r["q0"] for r in q.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert re.search(r"hashpartitioning\(zip#\d+L?, _salt#\d+", text)
    assert re.search(r"hashpartitioning\(zip#\d+L?, _b#\d+, \d+\), REPARTITION_BY_COL", text)
    want = df.groupBy("zip").agg(F.expr("percentile(x, 0.5)").alias("m")).collect()
    assert got == {r["zip"]: r["m"] for r in want}


def test_worst_sellers_runs_no_rank(spark):
    import __spark_entry__ as E
    text = plan(E.queries()["worst_sellers"](spark, SF001))
    assert "Window" not in text and "percentile_approx" not in text


def test_nothing_is_broadcast_by_force():
    import pathlib
    root = pathlib.Path(__file__).parent.parent / "parcelyze"
    for p in [*root.rglob("*.py"), *root.rglob("*.sql")]:
        if "llm" not in p.parts:
            assert "broadcast(" not in p.read_text().lower(), p
