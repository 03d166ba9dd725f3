"""Versioned runs: consistent replace, re-runs that write what changed, reconciliation."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from parcelyze.operators.reconcile import differing_ranges, reconcile, table_digest
from parcelyze.plans import snapshots as V
from parcelyze.schemas import MODELED_TABLES
from parcelyze.sources.adapter import raw_model

from .conftest import SF001


def files(root):
    return {os.path.join(d, f) for d, _, names in os.walk(root) for f in names}


@pytest.fixture(scope="module")
def first(spark):
    root = tempfile.mkdtemp(prefix="pz-snap-")
    raw = dict(raw_model(spark, SF001).items())
    return root, raw, V.run_snapshot(spark, raw, root, "t1")[0]


def test_a_version_holds_the_whole_model(spark, first, small_model):
    root, _, snap = first
    assert snap.version == 1 and V.current(spark, root).tables == snap.tables
    for name in MODELED_TABLES:
        lazy = getattr(small_model, name)
        got = getattr(snap, name).select(*lazy.columns)
        assert got.exceptAll(lazy).count() == 0 and got.count() == lazy.count(), name
    assert snap.data_quality_results.count() == 19


def test_a_second_run_writes_nothing_but_the_log(spark, first):
    root, raw, snap = first
    before = files(root)
    again, log = V.run_snapshot(spark, raw, root, "t2")
    assert again.version == snap.version and again.tables == snap.tables
    assert all("/pipeline_runs/" in f for f in files(root) - before)
    assert [r["stage"] for r in log.rows] == ["ingest", "validate_raw", "transform_load", "validate_modeled", "pipeline"]
    assert {r["run_ts"] for r in again.data_quality_results.collect()} == {"t1"}


def test_one_changed_table_rebuilds_what_depends_on_it(spark, first):
    root, raw, _ = first
    old = V.current(spark, root)
    moved = {**raw, "raw_sellers": raw["raw_sellers"].withColumn("seller_state", F.lit("ZZ")).repartition(3)}
    snap, _ = V.run_snapshot(spark, moved, root, "t3")
    assert snap.version == old.version + 1
    new = {k for k, v in snap.tables.items() if v[0] != old.tables[k][0]}
    assert new == {("raw", "raw_sellers"), ("dq", "raw"), ("model", "dim_seller"), ("dq", "modeled")}
    assert {r["state"] for r in snap.dim_seller.select("state").distinct().collect()} == {"ZZ"}
    assert old.dim_seller.filter("state = 'ZZ'").count() == 0               # a reader of the old version is undisturbed
    back, _ = V.run_snapshot(spark, raw, root, "t4")
    assert back.dim_seller.filter("state = 'ZZ'").count() == 0


def test_a_run_killed_between_tables_leaves_the_old_version(spark, first, monkeypatch):
    root, raw, _ = first
    old = V.current(spark, root)
    changed = {**raw, "raw_orders": raw["raw_orders"].filter("order_id <> '1'"),
               "raw_customers": raw["raw_customers"].withColumn("customer_state", F.lit("QQ"))}
    real, seen = V.write_table, []

    def fails(df, path, name):
        if name == "fact_orders":
            raise RuntimeError("executors lost")
        seen.append(name)
        return real(df, path, name)
    monkeypatch.setattr(V, "write_table", fails)
    with pytest.raises(RuntimeError, match="executors lost"):
        V.run_snapshot(spark, changed, root, "t5")
    assert "dim_customer" in seen                                           # some tables had been written
    now = V.current(spark, root)
    assert now.version == old.version and now.tables == old.tables
    assert now.dim_customer.filter("state = 'QQ'").count() == 0 and now.fact_orders.count() == old.fact_orders.count()
    status = {r["status"] for r in spark.read.json(f"{root}/pipeline_runs").filter("stage = 'pipeline'").collect()}
    assert "FAILED" in status
    monkeypatch.setattr(V, "write_table", real)
    assert V.run_snapshot(spark, changed, root, "t6")[0].dim_customer.filter("state <> 'QQ'").count() == 0


def test_no_version_yet(spark):
    assert V.current(spark, tempfile.mkdtemp(prefix="pz-snap-")) is None


def test_digests_do_not_depend_on_order(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None), (None, "")], "k int, v string")
    same = table_digest(df)
    assert all(table_digest(d) == same for d in (df.repartition(7), df.orderBy("v"), df.coalesce(1)))
    others = [df.limit(3), df.union(df), df.withColumn("v", F.coalesce("v", F.lit(""))), df.withColumnRenamed("v", "w"),
              spark.createDataFrame([(1, None), (2, "a"), (2, None), (None, "")], "k int, v string")]
    assert len({same, *map(table_digest, others)}) == 6


def test_a_swapped_pair_is_found(spark):
    rows = [(str(i), f"c{i}", i) for i in range(3000)]
    swapped = [*rows]
    swapped[10], swapped[2000] = ("10", "c2000", 10), ("2000", "c10", 2000)
    a, b = (spark.createDataFrame(r, "order_id string, customer_id string, n int") for r in (rows, swapped))
    assert a.count() == b.count()
    assert 1 <= differing_ranges(a, b, "order_id", a.columns, 64).count() <= 2
    got = sorted(tuple(r) for r in reconcile(a, b, "order_id", a.columns, 64).collect())
    assert got == sorted([("10", "c10", 10, 1, 0), ("10", "c2000", 10, 0, 1), ("2000", "c2000", 2000, 1, 0), ("2000", "c10", 2000, 0, 1)])
    assert reconcile(a, a.repartition(9), "order_id", a.columns).count() == 0


def test_missing_repeated_and_null_rows_are_found(spark):
    a = spark.createDataFrame([("1", 1), ("1", 1), ("2", 2), (None, 3), ("4", None)], "k string, v int")
    b = spark.createDataFrame([("1", 1), ("3", 2), (None, 3), (None, 3), ("4", None)], "k string, v int")
    got = {(r.k, r.v): (r.left_only, r.right_only) for r in reconcile(a, b, "k", ["k", "v"], 8).collect()}
    assert got == {("1", 1): (1, 0), ("2", 2): (1, 0), ("3", 2): (0, 1), (None, 3): (0, 1)}
