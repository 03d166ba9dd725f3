"""CSV ingest (SRC1/SRC2, trap T18/T19) and the four-stage pipeline (PL1)."""

import os
import tempfile

import pytest

from parcelyze.plans.pipeline import run_pipeline
from parcelyze.sources.ingest import CSV_FILES, ingest_csv, read_raw_layer

from .conftest import SF001


def _write_csvs(d, orders_text):
    headers = {
        "raw_orders": "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
                      "order_delivered_carrier_date,order_delivered_customer_date,"
                      "order_estimated_delivery_date",
        "raw_order_items": "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value",
        "raw_order_payments": "order_id,payment_sequential,payment_type,payment_installments,payment_value",
        "raw_order_reviews": "review_id,order_id,review_score,review_comment_message",
        "raw_customers": "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state",
        "raw_sellers": "seller_id,seller_zip_code_prefix,seller_city,seller_state",
        "raw_products": "product_id,product_category_name,product_weight_g,product_length_cm,"
                        "product_height_cm,product_width_cm,product_photos_qty",
        "raw_geolocation": "geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,"
                           "geolocation_city,geolocation_state",
        "raw_category_translation": "product_category_name,product_category_name_english",
    }
    bodies = {
        "raw_orders": orders_text,
        "raw_order_reviews": 'r1,o1,5,"great\nproduct, fast"\nr2,o2,NA,\n',
        "raw_customers": "c1,u1,01037,sao paulo,SP\n",
    }
    for name, f in CSV_FILES.items():
        with open(os.path.join(d, f), "w", encoding="utf-8") as fh:
            prefix = "﻿" if name == "raw_orders" else ""
            fh.write(prefix + headers[name] + "\n" + bodies.get(name, ""))


def test_csv_ingest_quirks(spark):
    src, out = tempfile.mkdtemp(prefix="pz-csv-"), tempfile.mkdtemp(prefix="pz-raw-")
    _write_csvs(src, "o1,c1,delivered,2018-01-02 10:00:00,2018-01-02,garbage,,2018-01-20 00:00:00\n"
                     "o2,c1,NA,2018-01-03 10:00:00,,,,\n")
    counts = ingest_csv(spark, src, out)
    assert counts["raw_orders"] == 2 and counts["raw_order_reviews"] == 2
    raw = read_raw_layer(spark, out)
    o = {r["order_id"]: r for r in raw["raw_orders"].collect()}
    assert set(o) == {"o1", "o2"}                                   # BOM header stripped
    assert o["o1"]["order_approved_at"] is None                     # T19: date-only -> NULL
    assert o["o1"]["order_delivered_carrier_date"] is None          # garbage -> NULL
    assert o["o1"]["order_delivered_customer_date"] is None         # empty -> NULL
    assert o["o2"]["order_status"] is None                          # 'NA' -> NULL
    rv = {r["order_id"]: r["review_score"] for r in raw["raw_order_reviews"].collect()}
    assert rv == {"o1": 5, "o2": None}                              # quoted newline kept in one row
    assert raw["raw_customers"].first()["customer_zip_code_prefix"] == 1037


def test_csv_missing_file_fails_before_writing(spark):
    src, out = tempfile.mkdtemp(prefix="pz-csv-"), tempfile.mkdtemp(prefix="pz-raw-")
    _write_csvs(src, "")
    os.remove(os.path.join(src, CSV_FILES["raw_sellers"]))
    with pytest.raises(FileNotFoundError):
        ingest_csv(spark, src, out)
    assert os.listdir(out) == []


def test_pipeline_end_to_end_rerunnable(spark):
    from parcelyze.sources.adapter import raw_model
    root = tempfile.mkdtemp(prefix="pz-run-")
    raw = raw_model(spark, SF001)
    run_pipeline(spark, raw, root, run_ts="t1")
    _, log = run_pipeline(spark, raw, root, run_ts="t2")           # re-run: full replace
    stages = [(r["stage"], r["status"]) for r in log.rows]
    assert stages == [("ingest", "OK"), ("validate_raw", "OK"), ("transform_load", "OK"),
                      ("validate_modeled", "OK"), ("pipeline", "SUCCESS")]
    dq = spark.read.parquet(f"{root}/data_quality_results")
    assert dq.count() == 19                                         # no duplicate growth (T17)
    assert {r["run_ts"] for r in dq.collect()} == {"t2"}
    fact = spark.read.parquet(f"{root}/model/fact_orders")
    assert fact.count() == 1500
    assert log.frame().count() == 10                                # JSON-lines log appends


def test_pipeline_logs_failure(spark):
    root = tempfile.mkdtemp(prefix="pz-run-")

    def bad_ingest(path):
        raise RuntimeError("source unavailable")
    with pytest.raises(RuntimeError):
        run_pipeline(spark, bad_ingest, root)
    assert spark.read.json(f"{root}/pipeline_runs").first()["status"] == "FAILED"


def test_pipeline_from_csv(spark):
    from parcelyze.plans.pipeline import csv_source
    src, root = tempfile.mkdtemp(prefix="pz-csv-"), tempfile.mkdtemp(prefix="pz-run-")
    _write_csvs(src, "o1,c1,delivered,2018-01-02 10:00:00,2018-01-02 11:00:00,2018-01-03 09:00:00,"
                     "2018-01-09 12:00:00,2018-01-20 00:00:00\n")
    _, log = run_pipeline(spark, csv_source(spark, src), root, run_ts="t")
    assert [r["status"] for r in log.rows][-1] == "SUCCESS"
    f = spark.read.parquet(f"{root}/model/fact_orders").first()
    assert f["order_id"] == "o1" and f["on_time_flag"] == 1 and f["review_score"] == 5.0


def test_table_exists(spark):
    from parcelyze.session import path_exists, table_exists
    d = tempfile.mkdtemp(prefix="pz-te-")
    spark.range(3).write.parquet(f"{d}/t")
    assert table_exists(spark, f"{d}/t") and not table_exists(spark, f"{d}/nope")
    assert path_exists(spark, f"file://{d}/t") and not path_exists(spark, f"file://{d}/nope")
    assert not table_exists(spark, "no_such_table_xyz")


def test_csv_first_occurrence_follows_file_order(spark):
    """With an ingest sequence, "first" means first in the file (as pandas'
    value_counts tie-break and drop_duplicates keep='first'), even when line
    numbers or column values order the rows differently."""
    from parcelyze.operators.model import StarModel
    src, out = tempfile.mkdtemp(prefix="pz-csv-"), tempfile.mkdtemp(prefix="pz-raw-")
    _write_csvs(src, "o1,c1,delivered,2018-01-02 10:00:00,,,,\n")
    items = ("order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
             "o1,2,pC,s2,2018-01-09 00:00:00,5.00,1.00\n"
             "o1,1,pB,s1,2018-01-05 00:00:00,10.00,1.00\n"
             "o1,1,pA,s1,2018-01-01 00:00:00,20.00,1.00\n")
    pays = ("order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
            "o1,2,voucher,1,5.00\no1,1,boleto,2,30.00\n")
    with open(os.path.join(src, CSV_FILES["raw_order_items"]), "w") as fh:
        fh.write(items)
    with open(os.path.join(src, CSV_FILES["raw_order_payments"]), "w") as fh:
        fh.write(pays)
    ingest_csv(spark, src, out)
    m = StarModel(read_raw_layer(spark, out))
    f = m.fact_orders.first()
    assert f["seller_id"] == "s1"             # s1 has 2 rows (duplicates count, T4)
    assert f["payment_type"] == "voucher"     # 1-1 tie: voucher comes first in the file
    first = {r["item_number"]: r["product_id"] for r in m.fact_order_items.collect()}
    assert first == {1: "pB", 2: "pC"}        # keep the first row of (o1, 1) in file order
    assert "_seq" not in m.fact_order_items.columns


def test_csv_seller_tie_goes_to_first_seen(spark):
    from parcelyze.operators.model import StarModel
    src, out = tempfile.mkdtemp(prefix="pz-csv-"), tempfile.mkdtemp(prefix="pz-raw-")
    _write_csvs(src, "o1,c1,delivered,2018-01-02 10:00:00,,,,\n")
    with open(os.path.join(src, CSV_FILES["raw_order_items"]), "w") as fh:
        fh.write("order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
                 "o1,2,pC,s2,2018-01-09 00:00:00,5.00,1.00\n"
                 "o1,1,pB,s1,2018-01-05 00:00:00,10.00,1.00\n")
    ingest_csv(spark, src, out)
    assert StarModel(read_raw_layer(spark, out)).fact_orders.first()["seller_id"] == "s2"


def test_csv_round_trip_of_all_raw_tables(spark):
    """Export the adapted sf0.001 raw tables as CSV files (one file each, the
    export names), ingest them, and get the same rows and types back."""
    import glob
    import shutil

    from parcelyze.schemas import RAW
    from parcelyze.sources.adapter import raw_model
    raw = raw_model(spark, SF001)
    tmp, src, out = (tempfile.mkdtemp(prefix=p) for p in ("pz-exp-", "pz-csv-", "pz-raw-"))
    for name, df in raw.items():
        (df.coalesce(1).write.option("header", True)
         .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(f"{tmp}/{name}"))
        part = glob.glob(f"{tmp}/{name}/part-*.csv")[0]
        shutil.copyfile(part, os.path.join(src, CSV_FILES[name]))
    counts = ingest_csv(spark, src, out)
    back = read_raw_layer(spark, out)
    for name, df in raw.items():
        cols = [f.name for f in RAW[name].fields]
        got = back[name].select(*cols)
        types = lambda d: [(f.name, f.dataType) for f in d.schema.fields]
        assert types(got) == types(df.select(*cols)), name
        assert counts[name] == df.count()
        assert got.exceptAll(df.select(*cols)).count() == 0, name
        assert df.select(*cols).exceptAll(got).count() == 0, name


def test_pipeline_tables_equal_lazy_model(spark, small_model):
    """SNK1 round trip: every written modeled table equals the lazily planned one."""
    from parcelyze.operators.model import TableModel
    from parcelyze.schemas import FACT_ORDERS_COLS, MODELED_TABLES
    from parcelyze.sources.adapter import raw_model
    root, _ = run_pipeline(spark, raw_model(spark, SF001), tempfile.mkdtemp(prefix="pz-run-"), run_ts="t")
    written = TableModel(spark, f"{root}/model")
    for name in MODELED_TABLES:
        lazy = getattr(small_model, name)
        got = getattr(written, name)
        if name == "fact_orders":
            got = got.select(*FACT_ORDERS_COLS)
        got = got.select(*lazy.columns)
        assert got.count() == lazy.count(), name
        assert got.exceptAll(lazy).count() == 0 and lazy.exceptAll(got).count() == 0, name
