"""A training-corpus pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. ``run`` writes
every stage's rows as Parquet under the shared checkpoint folder and reads them
again as the next stage's ``docs``, so a lost executor never costs more than
one stage and no plan grows over several of them. All stages but the last
return the columns of ``documents``.

No SQL twin: compression, the classifier and MinHash have none. The stages are
tested against brute-force versions in ``tests/llm``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelyze.llm import language_id, minhash, mixing, packing, toxicity
from parcelyze.llm.common import columns, free_name, materialize, table

ORACLE_SQL = None


def language_stage(spark, docs, sf_dir):
    """Drop documents whose language the compressors cannot tell."""
    model = language_id.fit(docs, train=language_id.train_fold())
    names = [free_name(docs.columns, n) for n in ("lang_pred", "score", "rejected")]
    kept = language_id.predict(docs, model, names=names).filter(~F.col(names[2]))
    return kept.select(*columns(docs.columns))


def toxicity_stage(spark, docs, sf_dir):
    """Drop documents that the classifier calls toxic."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), train=toxicity.train_fold())
    names = [free_name(docs.columns, n) for n in ("score", "predicted")]
    kept = toxicity.predict(docs, model, names=names).filter(F.col(names[1]) == 0)
    return kept.select(*columns(docs.columns))


def near_dedup_stage(spark, docs, sf_dir):
    """Keep one document of every group of near copies: five-word shingles,
    similarity 0.8 or more. Rows are compared by themselves, whatever their ids: two
    different texts under one id are two documents, and a row without an id is one
    too. Of a group the row with the smallest id stays (NULL is the largest), among
    equal ids the one whose text has the smallest MD5. Rows without a word are
    linked with nothing and stay.

    Rows are numbered and written first, so that every step sees the same numbers."""
    row = free_name(docs.columns, "row_number")
    docs_ = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "near-dedup-rows")
    groups = materialize(minhash.near_duplicates(docs_, id_col=row, words=5), "near-dedup-groups")
    # of most groups there is one row: only the rest is ordered
    several = groups.groupBy("component_id").agg(F.count("*").alias("n")).filter("n > 1").select("component_id")
    linked = groups.join(several, "component_id").select(F.col("id").alias(row), "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("x"), F.col("doc_id").alias("y"),
                     F.md5(F.col("text").cast("binary")).alias("z"), F.col(row).alias("row"))
    keys = materialize(docs_.select(row, order.alias("order")).join(linked, row), "near-dedup-order")
    stay = keys.groupBy("component_id").agg(F.min("order")["row"].alias(row))
    dropped = keys.select(row).join(stay.select(row), row, "left_anti")
    return docs_.join(dropped, row, "left_anti").select(*columns(docs.columns))


def mixing_stage(spark, docs, sf_dir):
    """Repeat or thin the sources to their target weights."""
    return mixing.emit(docs)


def packing_stage(spark, docs, sf_dir):
    """Pieces of packed sequences; a document's copies are packed one by one."""
    return packing.pack(docs)


STAGES = [("language ID", language_stage), ("toxicity", toxicity_stage), ("near dedup", near_dedup_stage),
          ("mixing", mixing_stage), ("packing", packing_stage)]


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
