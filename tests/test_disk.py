"""What a job leaves on disk while it runs: no shuffle files of steps that have ended, no
second copy of its input, no intermediate table that nothing reads any more."""

import csv
import os
import time

from pyspark.sql import functions as F

from parcelyze import session
from parcelyze.operators import ranking
from parcelyze.plans import queries_reports as R
from parcelyze.plans import pipeline, registry, snapshots
from parcelyze.sources import csv_records as C
from parcelyze.sources import ingest as I

from .test_joins import _driver_tables


def shuffle_files(spark) -> set:
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f for f in found.split("\n") if "/shuffle_" in f}


def left_by(spark, run) -> set:
    """Shuffle files that a job added and that are still there; deletes are asynchronous."""
    before = shuffle_files(spark)
    keep = run()
    for _ in range(50):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.2)
    assert keep is not None
    return left


def test_runs_leave_no_shuffle_files(spark, tmp_path):
    raw = R.raw_model(spark, _driver_tables(spark, tmp_path / "in"))
    old = spark.conf.get(session._DROP_SHUFFLES)
    assert not left_by(spark, lambda: pipeline.run_pipeline(spark, raw, str(tmp_path / "run"), "t"))
    assert not left_by(spark, lambda: snapshots.run_snapshot(spark, raw, str(tmp_path / "snap"), "t"))
    assert spark.conf.get(session._DROP_SHUFFLES) == old                    # the session is as it was


def test_a_query_of_an_ended_job_can_be_run_again(spark):
    with session.shuffles_dropped(spark):
        with session.shuffles_dropped(spark):
            df = spark.range(100).groupBy((F.col("id") % 7).alias("k")).count()
        first = sorted(df.collect())
    assert sorted(df.collect()) == first and len(first) == 7


def test_pipeline_queries_store_the_input_once(spark, tmp_path):
    folder = _driver_tables(spark, tmp_path)
    assert R.q_pipeline_dq_results(spark, folder).count() == 19
    rows = {r["name"]: (r["row_count"], r["rewritten"]) for r in R.q_pipeline_snapshot(spark, folder).collect()}
    assert rows["raw_orders"] == (6, False) and rows["dim_seller"] == (1, True)
    assert not [k for k in registry._MODELS if k[1] == folder]              # no model beside the run's own


def test_facts_are_written_one_after_another(spark):
    running, most, order = [], [], []

    def write(name):
        running.append(name)
        order.append(name)
        time.sleep(0.05)
        most.append((name, len(running)))
        running.remove(name)
        return len(name)
    names = ["dim_date", "dim_seller", "fact_order_items", "fact_orders"]
    assert pipeline.write_modeled(names, write) == {n: len(n) for n in names}
    assert order[2:] == ["fact_orders", "fact_order_items"] and all(n == 1 for t, n in most if t.startswith("fact"))


def intermediates(spark) -> set:
    """Text of CSV files that is still in the scratch folder."""
    folder = session.scratch_path(spark, "materialized", session.app_id(spark)).removeprefix("file:")
    return {f for f in os.listdir(folder) if f.startswith(("csv-lines", "csv-places", "csv-records"))} if os.path.isdir(folder) else set()


def test_csv_queries_keep_the_export_and_the_layers_only(spark, tmp_path):
    folder, before = _driver_tables(spark, tmp_path), intermediates(spark)
    raw = R.raw_model(spark, folder)
    shuffles = left_by(spark, lambda: R.csv_round_trip(spark, folder))
    assert not shuffles and intermediates(spark) == before                  # what was landed is not kept a second time
    for name, df in R.csv_round_trip(spark, folder).items():
        got = df.drop("_seq")
        assert got.exceptAll(df.sparkSession.createDataFrame(raw[name].collect(), raw[name].schema)).count() == 0, name
    counts = {r["table_name"]: r["row_count"] for r in R.q_csv_ingest_counts(spark, folder).collect()}
    assert counts == {name: df.count() for name, df in raw.items()}
    assert R.q_csv_ingest_items(spark, folder).count() == 1
    assert not [k for k in registry._MODELS if k[1] == folder]


def test_compressed_exports_are_read_like_plain_ones(spark, tmp_path):
    df = spark.range(25).select(F.col("id").cast("string").alias("order_id"), F.lit(5).alias("review_score"))
    seen = []
    for codec in ("none", "gzip"):
        I.write_csv({"raw_order_reviews": df.coalesce(1)}, f"{tmp_path}/{codec}", codec, 10)
        source = f"{tmp_path}/{codec}/{I.CSV_FILES['raw_order_reviews']}"
        assert len([f for f in os.listdir(source) if f.startswith("part-")]) == 3
        seen.append(sorted(tuple(r) for r in C.read_text_table(spark, source).collect()))
    assert seen[0] == seen[1] == sorted((str(i), "5") for i in range(25))


def test_small_splits_share_tasks(spark, tmp_path):
    rows = [(str(i), f'note "{i}",\nof {i}\n', "" if i % 3 else "x") for i in range(300)]
    for j in range(3):
        with open(f"{tmp_path}/part-{j}.csv", "w", newline="") as f:
            w = csv.writer(f, quoting=csv.QUOTE_ALL, lineterminator="\n")
            w.writerows([("k", "text", "n"), *rows[j * 100:(j + 1) * 100]])
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.maxPartitionNum"]
    old = [spark.conf.get(n, None) for n in names]
    made: list = []
    lines = C.read_lines(spark, str(tmp_path), made, "97")
    parts = [f for f in os.listdir(made[0].removeprefix("file:")) if f.startswith("part-")]
    assert lines.select("_file", "_start").distinct().count() > 60 and len(parts) <= 10
    assert [spark.conf.get(n, None) for n in names] == old
    written: list = []
    got = C.read_text_table(spark, str(tmp_path), "_seq", written, "97").orderBy("_seq").collect()
    assert [(r.k, r.text, r.n or "", r["_seq"]) for r in got] == [(*r, i) for i, r in enumerate(rows)]
    assert len(written) == 1 and os.path.exists(written[0].removeprefix("file:"))
    session.drop_folders(spark, [*made, *written])
    assert not os.path.exists(written[0].removeprefix("file:"))


def test_empty_lines_and_headers_do_not_count(spark, tmp_path):
    texts = ["k,t\n1,a\n\n2,b\n\n\n", "k,t\n\n", "k,t\n3,c\n", "k,t\n4,\"d\nd\"\n\n\n5,e\n"]
    for upto in (3, 4):                                                     # without and with a record over two lines
        folder = tmp_path / str(upto)
        folder.mkdir()
        for j, text in enumerate(texts[:upto]):
            (folder / f"part-{j}.csv").write_text(text)
        got = C.read_text_table(spark, str(folder), "_seq").orderBy("_seq").collect()
        want = [("1", "a", 0), ("2", "b", 2), ("3", "c", 3), ("4", "d\nd", 4), ("5", "e", 7)]
        assert [tuple(r) for r in got] == want[:upto if upto == 3 else 5]


def test_buckets_of_ranks_by_halving(spark):
    for cuts in ([], [3], [1, 1, 4, 7, 7, 7, 9]):
        for most in (len(cuts), 511):
            df = spark.range(-1, 11).select("id", F.lit(cuts).cast("array<bigint>").alias("c"))
            got = df.select("id", ranking._below("c", F.col("id"), most).alias("b")).collect()
            assert [(r.id, r.b) for r in got] == [(i, sum(c < i for c in cuts)) for i in range(-1, 11)]
