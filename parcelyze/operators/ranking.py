"""Order statistics without a single-partition window: global RANK() and exact
quantiles.

Both need, for each distinct key value, the number of rows with a smaller key.
``rank() OVER (ORDER BY key)`` or a sort-then-index would move every row to one
task. Here the key is first reduced to its distinct values with counts (so a
value shared by a third of all rows is one row), the distinct values are cut
into value-range buckets at approximate quantiles (a one-value scalar
subquery), and

    rows before v = rows in earlier buckets + rows below v in v's bucket.

Equal keys always share a bucket, so results are exact; only bucket sizes
depend on the approximation. The per-bucket totals are one row per bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, merged

_UNB = Window.unboundedPreceding
#: Parts that a group's distinct values are dealt into when they meet its cuts.
SALTS = 16


def distinct_counts(df: DataFrame, key: Column | str) -> DataFrame:
    """Distinct values ``_k`` with row counts ``_n``, materialized once.

    The later passes (cut points, bucket offsets, lookups) all read this
    table, which is far smaller than the input; a table written to the shared
    checkpoint folder cuts the lineage so the input is scanned once."""
    k = F.col(key) if isinstance(key, str) else key
    return materialize(df.groupBy(k.alias("_k")).agg(F.count(F.lit(1)).alias("_n")), "counts")


def _below(cuts: str, value: Column, most: int) -> Column:
    """How many of at most ``most`` ascending cuts are smaller than the value, by halving."""
    steps = [1 << i for i in reversed(range(most.bit_length()))]
    return F.aggregate(F.array(*[F.lit(x) for x in steps]), F.lit(0), lambda at, step: F.when(
        at + step <= F.size(cuts), F.when(F.element_at(cuts, at + step) < value, at + step).otherwise(at)).otherwise(at))


def value_positions(df: DataFrame, key: Column | str, buckets: int = 512,
                    counted: DataFrame | None = None) -> DataFrame:
    """Distinct key values ``_k`` (NULL first) with ``_n`` = rows holding the value
    and ``_start`` = rows with a smaller key (0-based start position).
    ``counted``: an existing distinct_counts() result to reuse."""
    vals = counted if counted is not None else distinct_counts(df, key)
    probs = [i / buckets for i in range(1, buckets)]
    cuts = (vals.filter(F.col("_k").isNotNull())
            .select(F.percentile_approx("_k", probs, 10000)).scalar())
    # bucket -1 holds the NULL key, which sorts first. (The cut list is
    # projected as a column first: subqueries may not sit inside a lambda.)
    b = F.when(F.col("_k").isNull(), F.lit(-1)).otherwise(
        _below("_cuts", F.col("_k"), buckets - 1))
    vals = vals.withColumn("_cuts", cuts).withColumn("_b", b).drop("_cuts")
    # per-bucket totals: <= buckets + 1 rows, so the running offsets and the
    # grand total are windows over a handful of rows
    offsets = (vals.groupBy("_b").agg(F.sum("_n").alias("_bn"))
               .select("_b", F.coalesce(F.sum("_bn").over(
                   Window.orderBy("_b").rowsBetween(_UNB, -1)), F.lit(0)).alias("_off"),
                       F.sum("_bn").over(Window.partitionBy()).alias("_tot")))
    local = vals.select("_k", "_n", "_b", F.coalesce(F.sum("_n").over(
        Window.partitionBy("_b").orderBy("_k").rowsBetween(_UNB, -1)), F.lit(0)).alias("_before"))
    return local.join(offsets, "_b").select(
        "_k", "_n", (F.col("_off") + F.col("_before")).cast("bigint").alias("_start"),
        F.col("_tot").cast("bigint").alias("_tot"))


def _lerp(i: int) -> Column:
    """lo * (1 - d) + hi * d: the interpolation form percentile() uses."""
    d = F.col(f"_d{i}")
    return F.col(f"_lo{i}") * (1 - d) + F.col(f"_hi{i}") * d


def global_rank(df: DataFrame, key: str, out: str = "rank", buckets: int = 512,
                write_input: bool = True) -> DataFrame:
    """Add ``out`` = RANK() OVER (ORDER BY key ASC NULLS FIRST) as bigint, for a
    numeric or date key (the bucket cuts come from percentile_approx).

    ``write_input``: write ``df`` once first, so that counting, bucketing and
    the join back all read it once instead of recomputing its lineage (use for
    aggregated inputs such as one row per seller)."""
    if write_input:
        df = materialize(df, "ranked")
        counted = df.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
        pos = value_positions(None, key, buckets, counted)
    else:
        pos = value_positions(df, key, buckets)
    pos = pos.select("_k", (F.col("_start") + 1).alias(out))  # rank = rows before + 1
    return df.join(merged(pos), df[key].eqNullSafe(pos["_k"]), "inner").drop("_k")


def exact_quantiles(df: DataFrame, col: str, probs, buckets: int = 512,
                    counted: DataFrame | None = None) -> DataFrame:
    """One row: exact linear-interpolation quantiles of the non-NULL values of
    ``col`` (same definition as percentile / numpy 'linear'), column q<i> per
    probability; NULL when there are no values. ``counted``: distinct_counts()
    of the non-NULL values, when the caller already has it."""
    if counted is None:
        x = df.select(F.col(col).cast("double").alias("_x")).filter(F.col("_x").isNotNull())
        counted = distinct_counts(x, "_x")
    pos = value_positions(None, "_k", buckets, counted)
    lookups = []
    for i, p in enumerate(probs):
        h = (F.col("_tot") - 1) * F.lit(float(p))
        lo, hi = F.floor(h), F.ceil(h)
        covers = lambda r: (F.col("_start") <= r) & (r < F.col("_start") + F.col("_n"))
        lookups += [F.max(F.when(covers(lo), F.col("_k"))).alias(f"_lo{i}"),
                    F.max(F.when(covers(hi), F.col("_k"))).alias(f"_hi{i}"),
                    F.max(h - lo).alias(f"_d{i}")]
    r = pos.agg(*lookups)
    return r.select(*[_lerp(i).alias(f"q{i}") for i in range(len(probs))])


def grouped_exact_quantiles(df: DataFrame, groups, col: str, probs, buckets: int = 64) -> DataFrame:
    """Per group: exact linear-interpolation quantiles of the non-NULL values of
    ``col`` (columns q<i>), without holding a whole group in one task.

    Distinct (group, value) counts are materialized once (this runs a job); each
    group's values are cut into ``buckets`` value ranges at that group's
    approximate quantiles (a bounded sketch per group); start positions come from
    per-group bucket totals (<= buckets rows per group) plus running sums inside
    one (group, bucket). Equal values share a bucket, so results are exact.

    A group holding a third of all rows must not meet its cut points in one
    task: values are salted by a hash, the cut points are repeated once per
    salt, and the join key is (group, salt). The bucketed values are then dealt
    by (group, bucket); without that explicit exchange the planner would keep
    the join's partitioning by group for the windows."""
    groups = list(groups)
    x = df.select(*groups, F.col(col).cast("double").alias("_x")).filter(F.col("_x").isNotNull())
    vc = materialize(x.groupBy(*groups, "_x").agg(F.count(F.lit(1)).alias("_n")), "gcounts")
    cut_p = [i / buckets for i in range(1, buckets)]
    cuts = vc.groupBy(*groups).agg(F.percentile_approx("_x", cut_p, 10000).alias("_cuts"),
                                   F.sum("_n").alias("_tot"))
    cuts = cuts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = vc.withColumn("_salt", F.pmod(F.xxhash64("_x"), F.lit(SALTS)).cast("int"))
    vb = (salted.join(merged(cuts), [*groups, "_salt"], "inner")
          .withColumn("_b", F.size(F.filter("_cuts", lambda c: c < F.col("_x")))).drop("_cuts", "_salt")
          .repartition(*groups, "_b"))
    offs = (vb.groupBy(*groups, "_b").agg(F.sum("_n").alias("_bn"))
            .select(*groups, "_b", F.coalesce(F.sum("_bn").over(
                Window.partitionBy(*groups).orderBy("_b").rowsBetween(_UNB, -1)), F.lit(0)).alias("_off")))
    local = vb.withColumn("_before", F.coalesce(F.sum("_n").over(
        Window.partitionBy(*groups, "_b").orderBy("_x").rowsBetween(_UNB, -1)), F.lit(0)))
    pos = local.join(merged(offs), [*groups, "_b"], "inner").withColumn("_start", F.col("_off") + F.col("_before"))
    aggs = []
    for i, p in enumerate(probs):
        h = (F.col("_tot") - 1) * F.lit(float(p))
        lo, hi = F.floor(h), F.ceil(h)
        covers = lambda r: (F.col("_start") <= r) & (r < F.col("_start") + F.col("_n"))
        aggs += [F.max(F.when(covers(lo), F.col("_x"))).alias(f"_lo{i}"),
                 F.max(F.when(covers(hi), F.col("_x"))).alias(f"_hi{i}"),
                 F.max(h - lo).alias(f"_d{i}")]
    r = pos.groupBy(*groups).agg(*aggs)
    return r.select(*groups, *[_lerp(i).alias(f"q{i}") for i in range(len(probs))])
