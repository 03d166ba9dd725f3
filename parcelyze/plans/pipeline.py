"""PL1: the batch job -- ingest -> validate_raw -> transform_load ->
validate_modeled, each layer written once to shared storage and read back
(which also cuts lineage), with a JSON-lines run log.

Storage root: the caller's path, or a subfolder of the cluster's
``spark.checkpoint.dir`` (never a machine-local temp folder on a cluster).
Re-runnable: every write is a full replace; DQ results are partitioned by
layer and replaced per layer (dynamic partition overwrite), so re-running
one validation stage never duplicates rows.
"""

from __future__ import annotations

import time
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators.model import StarModel, TableModel
from ..schemas import MODELED_TABLES
from ..session import app_id, dropping_shuffles, scratch_path, write_tables
from ..sources.ingest import read_raw_layer, write_raw

LOG_COLS = ["ts", "stage", "status", "detail"]

# Run-log detail formats per stage.
LOG_DETAIL = {
    "ingest": "{rows:,} raw rows in {secs:.1f}s",
    "validate_raw": "{n} checks, {flagged} flagged, {secs:.1f}s",
    "transform_load": "{rows:,} rows loaded, {secs:.1f}s",
    "validate_modeled": "{n} checks, {failed} failed, {secs:.1f}s",
    "pipeline": "total {secs:.1f}s",
}


def _now() -> str:
    return datetime.now(timezone.utc).isoformat()


class RunLog:
    """SNK4: one row per stage, appended as JSON lines under ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.rows = spark, path, []

    def log(self, stage: str, status: str, detail: str = ""):
        row = (_now(), stage, status, detail)
        self.rows.append(dict(zip(LOG_COLS, row)))
        (self.spark.createDataFrame([row], "ts string, stage string, status string, detail string")
         .coalesce(1).write.mode("append").json(self.path))

    def frame(self) -> DataFrame:
        return self.spark.read.schema("ts string, stage string, status string, detail string") \
            .json(self.path)


def write_dq(results: DataFrame, root: str, layer: str):
    """SNK2/SNK3: replace only this layer's partition of the DQ results table."""
    (results.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("layer").parquet(f"{root}/data_quality_results"))


def write_table(df: DataFrame, path: str, name: str) -> int:
    """Write one table; fact_orders is partitioned by month, so month filters prune
    files. Returns its rows (from the write's observation)."""
    if name == "fact_orders":
        # rebalance by month: AQE sizes the write tasks per month (splitting a
        # heavy month, merging small ones), so each month gets a few
        # right-sized files instead of one file per (task, month)
        df = (df.withColumn("year_month", F.date_format("order_purchase_timestamp", "yyyy-MM"))
              .hint("rebalance", "year_month"))
    obs = Observation(name)
    w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    if name == "fact_orders":
        w = w.partitionBy("year_month")
    w.parquet(path)
    return obs.get["rows"]


def write_modeled(names, write) -> dict:
    """Run ``write(name)`` for tables of the model: the dimensions side by side, then the
    facts one after another, as each shuffles lines of all orders and the files of
    one shuffle need not lie beside the other's; fact_orders, which shuffles most, before
    the lines are on disk once more. Returns {name: value}."""
    facts = [n for n in ("fact_orders", "fact_order_items") if n in names]
    done = write_tables({n: lambda n=n: write(n) for n in names if n not in facts})
    return {**done, **{n: write(n) for n in facts}}


def write_model(model: StarModel, root: str) -> int:
    """SNK1: full replace of the 7 modeled tables. Returns total rows."""
    return sum(write_modeled(MODELED_TABLES, lambda n: write_table(getattr(model, n), f"{root}/{n}", n)).values())


@dropping_shuffles
def run_pipeline(spark: SparkSession, raw_source, root: str | None = None,
                 run_ts: str | None = None) -> tuple[str, RunLog]:
    """Run all four stages. ``raw_source``: a raw model (name -> DataFrame), or
    a callable(root) that ingests raw files into ``root/raw`` and returns counts.
    Returns (root, log); re-raises after logging FAILED."""
    root = (root or scratch_path(spark, "parcelyze-runs", app_id(spark), uuid.uuid4().hex)).rstrip("/")
    log = RunLog(spark, f"{root}/pipeline_runs")
    run_ts = run_ts or _now()
    start = time.time()
    try:
        t0 = time.time()
        counts = raw_source(f"{root}/raw") if callable(raw_source) else write_raw(raw_source, f"{root}/raw")
        log.log("ingest", "OK", LOG_DETAIL["ingest"].format(rows=sum(counts.values()),
                                                             secs=time.time() - t0))

        raw = read_raw_layer(spark, f"{root}/raw")
        t0 = time.time()
        raw_dq = Q.raw_checks(raw, run_ts)
        write_dq(raw_dq, root, "raw")
        dq = spark.read.parquet(f"{root}/data_quality_results").filter("layer = 'raw'")
        s = dq.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("passed") == 0).alias("f")).first()
        log.log("validate_raw", "OK", LOG_DETAIL["validate_raw"].format(
            n=s["n"], flagged=s["f"], secs=time.time() - t0))

        t0 = time.time()
        rows = write_model(StarModel(raw), f"{root}/model")
        log.log("transform_load", "OK", LOG_DETAIL["transform_load"].format(rows=rows,
                                                                             secs=time.time() - t0))

        t0 = time.time()
        model = TableModel(spark, f"{root}/model")
        write_dq(Q.modeled_checks(model, raw["raw_orders"], run_ts), root, "modeled")
        dq = spark.read.parquet(f"{root}/data_quality_results").filter("layer = 'modeled'")
        s = dq.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("passed") == 0).alias("f")).first()
        status = "OK" if s["f"] == 0 else "DEGRADED"
        log.log("validate_modeled", status, LOG_DETAIL["validate_modeled"].format(
            n=s["n"], failed=s["f"], secs=time.time() - t0))

        log.log("pipeline", "SUCCESS", LOG_DETAIL["pipeline"].format(secs=time.time() - start))
        return root, log
    except Exception as e:
        log.log("pipeline", "FAILED", str(e))
        raise


def csv_source(spark: SparkSession, raw_dir: str):
    """A ``raw_source`` for run_pipeline that ingests the 9 CSV exports."""
    from ..sources.ingest import ingest_csv
    return lambda root: ingest_csv(spark, raw_dir, root)
