"""PL1 on versioned snapshots: readers never see a half-written run, and a run writes
only what has changed.

Every run writes into folders of its own. What a reader opens is listed in a catalog:
one line per table with its folder and a digest of its rows, added by a single append
when all stages have passed. A reader takes the lines of the latest version, so a run
that fails or is killed between tables leaves the version before it in place, and a
reader that is at work keeps reading its folders.

The digests (order-free, see ``operators.reconcile``) are the keys of the stages. A
raw table with the digest it had is not written again; a modeled table is built
again only if a raw table that it depends on has changed; a layer is validated again
only if one of its tables has. A run without any change writes its log and no more.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators.model import StarModel, TableModel
from ..operators.reconcile import table_digest
from ..schemas import MODELED_TABLES, RAW_TABLES
from ..session import dropping_shuffles, path_exists, write_tables
from .pipeline import LOG_DETAIL, RunLog, _now, write_modeled, write_table

#: The raw tables that each modeled table is built from.
DEPENDS = {
    "dim_date": ["raw_orders"], "dim_geography": ["raw_geolocation"], "dim_customer": ["raw_customers"],
    "dim_seller": ["raw_sellers"], "dim_product": ["raw_products", "raw_category_translation"],
    "fact_order_items": ["raw_order_items"],
    "fact_orders": ["raw_orders", "raw_order_items", "raw_order_payments", "raw_order_reviews"],
}
_CATALOG = "version long, run_ts string, layer string, name string, folder string, digest string"


class Snapshot(TableModel):
    """The tables of one version: modeled ones as attributes, ``raw``, and the stored
    check results."""

    def __init__(self, spark: SparkSession, version: int, tables: dict):
        self._spark, self.version, self.tables = spark, version, tables
        self.raw = {n: spark.read.parquet(f) for (layer, n), (f, _) in tables.items() if layer == "raw"}

    def _read(self, name):
        return self._spark.read.parquet(self.tables["model", name][0])

    @property
    def data_quality_results(self) -> DataFrame:
        return self._spark.read.parquet(self.tables["dq", "raw"][0]).unionByName(
            self._spark.read.parquet(self.tables["dq", "modeled"][0]))


def current(spark: SparkSession, root: str) -> Snapshot | None:
    """The latest published version under ``root``, if any."""
    path = f"{root.rstrip('/')}/catalog"
    if not path_exists(spark, path):
        return None
    lines = spark.read.schema(_CATALOG).json(path)
    last = lines.agg(F.max("version")).first()[0]
    if last is None:
        return None
    rows = lines.filter(F.col("version") == last).collect()              # one line a table
    return Snapshot(spark, last, {(r["layer"], r["name"]): (r["folder"], r["digest"]) for r in rows})


def publish(spark: SparkSession, root: str, version: int, run_ts: str, tables: dict) -> Snapshot:
    """Make a version the current one: one file with one line a table."""
    rows = [(version, run_ts, layer, name, folder, digest) for (layer, name), (folder, digest) in sorted(tables.items())]
    spark.createDataFrame(rows, _CATALOG).coalesce(1).write.mode("append").json(f"{root.rstrip('/')}/catalog")
    return Snapshot(spark, version, tables)


@dropping_shuffles
def run_snapshot(spark: SparkSession, raw: dict, root: str, run_ts: str | None = None) -> tuple[Snapshot, RunLog]:
    """Run the four stages on a raw model (name -> DataFrame) and publish the result.
    Returns the snapshot and the log; re-raises after logging FAILED."""
    root, run_ts, start = root.rstrip("/"), run_ts or _now(), time.time()
    log = RunLog(spark, f"{root}/pipeline_runs")
    try:
        before = current(spark, root)
        old = before.tables if before else {}
        folder = f"{root}/versions/{uuid.uuid4().hex}"
        tables, wrote = {}, {}

        t0 = time.time()
        digests = write_tables({n: lambda n=n: table_digest(raw[n]) for n in RAW_TABLES})
        changed = {n for n in RAW_TABLES if old.get(("raw", n), (None, None))[1] != digests[n]}

        def stage(layer, names, frame):
            """Write the tables of a layer that changed; keep the folders of the others."""
            counts = write_modeled(names, lambda n: write_table(frame(n), f"{folder}/{layer}/{n}", n))
            wrote.update({(layer, n): c for n, c in counts.items()})
            return {(layer, n): f"{folder}/{layer}/{n}" for n in names}

        new = stage("raw", sorted(changed), raw.__getitem__)
        tables.update({("raw", n): (new.get(("raw", n), old.get(("raw", n), ("",))[0]), digests[n]) for n in RAW_TABLES})
        log.log("ingest", "OK", LOG_DETAIL["ingest"].format(rows=sum(wrote.values()), secs=time.time() - t0))
        stored = {n: spark.read.parquet(tables["raw", n][0]) for n in RAW_TABLES}

        t0 = time.time()
        if changed or ("dq", "raw") not in old:
            Q.raw_checks(stored, run_ts).write.parquet(f"{folder}/dq/raw")
            tables["dq", "raw"] = (f"{folder}/dq/raw", run_ts)
        else:
            tables["dq", "raw"] = old["dq", "raw"]
        log.log("validate_raw", *_outcome(spark, tables["dq", "raw"][0], "validate_raw", t0))

        t0 = time.time()
        rebuilt = [n for n in MODELED_TABLES if changed.intersection(DEPENDS[n]) or ("model", n) not in old]
        star = StarModel(stored)
        new = stage("model", rebuilt, lambda n: getattr(star, n))
        for n in MODELED_TABLES:
            key = "/".join(digests[d] for d in DEPENDS[n])                  # a table is known by what it is built from
            tables["model", n] = (new.get(("model", n), old.get(("model", n), ("",))[0]), key)
        log.log("transform_load", "OK", LOG_DETAIL["transform_load"].format(
            rows=sum(c for (layer, _), c in wrote.items() if layer == "model"), secs=time.time() - t0))

        t0 = time.time()
        if rebuilt or "raw_orders" in changed or ("dq", "modeled") not in old:
            model = Snapshot(spark, 0, tables)
            Q.modeled_checks(model, stored["raw_orders"], run_ts).write.parquet(f"{folder}/dq/modeled")
            tables["dq", "modeled"] = (f"{folder}/dq/modeled", run_ts)
        else:
            tables["dq", "modeled"] = old["dq", "modeled"]
        log.log("validate_modeled", *_outcome(spark, tables["dq", "modeled"][0], "validate_modeled", t0))

        snapshot = before if before and tables == old else publish(
            spark, root, before.version + 1 if before else 1, run_ts, tables)
        log.log("pipeline", "SUCCESS", LOG_DETAIL["pipeline"].format(secs=time.time() - start))
        return snapshot, log
    except Exception as e:
        log.log("pipeline", "FAILED", str(e))
        raise


def _outcome(spark: SparkSession, folder: str, stage: str, t0: float) -> tuple:
    s = spark.read.parquet(folder).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("passed") == 0).alias("f")).first()
    status = "DEGRADED" if stage == "validate_modeled" and s["f"] else "OK"
    return status, LOG_DETAIL[stage].format(n=s["n"], flagged=s["f"], failed=s["f"], secs=time.time() - t0)
