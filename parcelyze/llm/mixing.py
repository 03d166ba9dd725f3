"""Mix sources to target weights with DataFrame operations only.

Sizes (words, by default) are summed per source, the targets follow from the
weights, and target / size is a source's repetition rate. A document is taken
floor(rate) times, plus once more when a number in [0, 1) drawn from the md5
of the seed and its id falls below the fraction of the rate. The draw depends
on nothing else, so reruns and retried tasks agree.

Null and empty texts have size 0 and are kept in the report; a source whose
documents are all empty has rate 0. Rows with the same id share their draw.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import columns, free_name, materialize

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def draw(id_col: Column, seed: int = 0) -> Column:
    """A number in [0, 1) from 48 bits of md5("seed:id")."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def targets(sized: DataFrame, weights=(3.0, 1.0, 2.0), share: float = 1.5, max_repeat: float = 2.0) -> DataFrame:
    """One row per source: source, source_size, target.

    ``weights`` repeat over the sources in code-point order, NULL last. The
    sources share ``share`` times all sizes by weight. No target exceeds
    ``max_repeat`` times its source's size; what a capped source leaves is
    reshared among the others. The fixed point is found in one pass: order the
    sources by cap / weight; the level per unit of weight is the first at which
    the next source is not capped.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("weight", w).withColumn("cap", F.col("source_size") * F.lit(float(max_repeat)))
    everything = Window.partitionBy()
    up = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    per = (per.withColumn("total", F.sum("source_size").over(everything) * F.lit(float(share)))
           .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
           .withColumn("w_left", F.sum("weight").over(everything)
                       - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
           .withColumn("level", (F.col("total") - F.col("cap_before")) / F.col("w_left")))
    open_ = F.col("cap") / F.col("weight") > F.col("level")
    per = per.withColumn("level", F.min(F.when(open_, F.struct(F.col("cap") / F.col("weight"), F.col("level"))))
                         .over(everything)["level"])
    return per.select("source", "source_size",
                      F.when(F.col("level").isNull(), F.col("cap"))
                      .otherwise(F.least(F.col("cap"), F.col("level") * F.col("weight"))).alias("target"))


def plan(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", weights=(3.0, 1.0, 2.0),
         share: float = 1.5, max_repeat: float = 2.0, seed: int = 0, size: Column | None = None) -> DataFrame:
    """One row per document: id, source, size, source_size, target, rate, copies.

    A source's documents are summed in every partition before the shuffle, and
    the per-source table goes back to them by an equi-join on the source that
    adaptive execution broadcasts or splits, so a source with a third of all rows
    meets no single task. ``copies`` never exceeds ceil(max_repeat).
    """
    sized = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                        (size if size is not None else word_count(F.col(text_col))).alias("size"))
    return _with_copies(sized, targets(sized, weights, share, max_repeat), seed)


def _with_copies(sized: DataFrame, t: DataFrame, seed: int) -> DataFrame:
    t = t.select(F.col("source").alias("t_source"), "source_size", "target")
    joined = sized.join(t, sized["source"].eqNullSafe(t["t_source"]), "left").drop("t_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    joined = joined.withColumn("rate", rate)
    whole = F.floor("rate")
    extra = (draw(F.col("id"), seed) < F.col("rate") - whole).cast("long")
    return joined.withColumn("copies", whole.cast("long") + extra)


def emit(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", weights=(3.0, 1.0, 2.0),
         share: float = 1.5, max_repeat: float = 2.0, seed: int = 0) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as the plan says, with
    the columns of ``docs``, whatever their names. The per-source table is written first (one job), so
    the planner knows its size: if it is small it is broadcast and no text moves."""
    name = {k: free_name(docs.columns, k) for k in ("size", "source", "rate", "n", "copy", "t_source", "t_size", "target")}
    col = {k: F.col(f"`{v}`") for k, v in name.items()}
    (text, src, ident) = columns([text_col, source_col, id_col])
    t = targets(docs.select(src.cast("string").alias("source"), word_count(text).alias("size")), weights, share, max_repeat)
    t = materialize(t, "mixing-targets").select(
        F.col("source").alias(name["t_source"]), F.col("source_size").alias(name["t_size"]), F.col("target").alias(name["target"]))
    rate = F.when(col["t_size"] > 0, col["target"] / col["t_size"]).otherwise(F.lit(0.0))
    j = docs.join(t, src.cast("string").eqNullSafe(col["t_source"]), "left").withColumn(name["rate"], rate)
    whole = F.floor(col["rate"])
    extra = (draw(ident, seed) < col["rate"] - whole).cast("long")
    j = j.withColumn(name["n"], (whole + extra).cast("int"))
    return (j.withColumn(name["copy"], F.explode(F.array_repeat(F.lit(1), col["n"])))
            .select(*columns(docs.columns)))
