"""Delay statistics: IQR outliers, seller z-scores, correlations, histogram.

One-value statistics (quantiles, population mean/std, histogram range) are
computed once and used as scalar subqueries, so the row-level pass is a plain
filter/projection -- no join, no single-partition window. Quantiles are exact
and distributed (see ranking.exact_quantiles); ``approx=True`` uses a
fixed-size sketch instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import clip, r2
from ..session import materialize
from .ranking import distinct_counts, exact_quantiles

DELAY = "delivery_delay_days"


# ------------------------------------------------------------------ IQR
def _value_counts(df: DataFrame, col: str) -> DataFrame:
    x = df.select(F.col(col).cast("double").alias("_x")).filter(F.col("_x").isNotNull())
    return distinct_counts(x, "_x")


def _fences(q: DataFrame, k: float) -> DataFrame:
    q1, q3 = F.col("q0"), F.col("q1")
    return q.select(q1.alias("q1"), q3.alias("q3"), (q3 - q1).alias("iqr"),
                    (q1 - F.lit(k) * (q3 - q1)).alias("lower_bound"),
                    (q3 + F.lit(k) * (q3 - q1)).alias("upper_bound"))


def iqr_fences(df: DataFrame, col: str = DELAY, k: float = 1.5, approx: bool = False,
               counted: DataFrame | None = None) -> DataFrame:
    """One row: q1, q3, iqr, lower_bound, upper_bound."""
    if approx:
        q = df.select(F.percentile_approx(col, [0.25, 0.75], 10000).alias("q")) \
              .select(F.col("q")[0].cast("double").alias("q0"), F.col("q")[1].cast("double").alias("q1"))
    else:
        q = exact_quantiles(df, col, [0.25, 0.75],
                            counted=counted if counted is not None else _value_counts(df, col))
    return _fences(q, k)


def iqr_outlier_rows(df: DataFrame, col: str = DELAY, k: float = 1.5, approx: bool = False) -> DataFrame:
    """ST1: rows strictly outside the fences (one scalar subquery, then a filter)."""
    f = iqr_fences(df, col, k, approx).select(F.struct("lower_bound", "upper_bound")).scalar()
    return (df.withColumn("_f", f)
            .filter((F.col(col) < F.col("_f.lower_bound")) | (F.col(col) > F.col("_f.upper_bound")))
            .drop("_f"))


def iqr_stats(df: DataFrame, col: str = DELAY, k: float = 1.5, approx: bool = False) -> DataFrame:
    """ST2/AGG15: fences plus outlier count and % of non-NULL values. In exact
    mode the outliers are counted from the materialized value counts, so the
    input is scanned once."""
    # The fences are one row: they reach the counting pass as one scalar
    # subquery held in a column, and the counts come back the same way.
    if approx:
        b = iqr_fences(df, col, k, True)
        rows, x, w = df.select(F.col(col).alias("_k"), F.lit(1).alias("_n")), F.col("_k"), F.col("_n")
    else:
        vc = _value_counts(df, col)
        b = iqr_fences(df, col, k, False, counted=vc)
        rows, x, w = vc, F.col("_k"), F.col("_n")
    fences = b.select(F.struct("lower_bound", "upper_bound")).scalar()
    out = (rows.filter(x.isNotNull()).withColumn("_f", fences)
           .agg(F.coalesce(F.sum(F.when((x < F.col("_f.lower_bound")) | (x > F.col("_f.upper_bound")), w)),
                           F.lit(0)).cast("bigint").alias("n_outliers"),
                F.coalesce(F.sum(w), F.lit(0)).alias("_n")))
    return (b.withColumn("_o", out.select(F.struct("n_outliers", "_n")).scalar())
            .select("q1", "q3", "iqr", "lower_bound", "upper_bound", F.col("_o.n_outliers").alias("n_outliers"),
                    r2(F.try_divide(F.lit(100.0) * F.col("_o.n_outliers"), F.col("_o._n")), 2)
                    .alias("pct_outliers")))


# -------------------------------------------------------------- z-score
def seller_delay_profile(fact: DataFrame) -> DataFrame:
    """Per seller over single-seller orders with a delay: count, mean delay, mean review."""
    f = fact.filter((F.col("n_sellers") == 1) & F.col(DELAY).isNotNull()
                    & F.col("seller_id").isNotNull())
    return f.groupBy("seller_id").agg(F.count("order_id").alias("order_count"),
                                      F.avg(DELAY).alias("avg_delay"),
                                      F.avg("review_score").alias("avg_review"))


def seller_zscore(fact: DataFrame, min_orders: int = 10, z_threshold: float = 1.5) -> DataFrame:
    """ST3: z of each seller's mean delay against the population of sellers with
    >= min_orders (mean and sample std over those sellers only); flag |z| >=
    threshold (two-sided). Zero or undefined spread gives z NULL, flag false.

    The per-seller rows are written once (this runs a job): the population's mean
    and spread and the scores read that small table, and the facts are read once."""
    kept = materialize(seller_delay_profile(fact).filter(F.col("order_count") >= min_orders), "sellers")
    pop = kept.select(F.struct(F.avg("avg_delay").alias("mu"),
                               F.stddev_samp("avg_delay").alias("sigma"))).scalar()
    z = F.try_divide(F.col("avg_delay") - F.col("_pop.mu"), F.col("_pop.sigma"))
    return (kept.withColumn("_pop", pop).withColumn("z_score", z).drop("_pop")
            .withColumn("is_anomalous", F.coalesce(F.abs("z_score") >= z_threshold, F.lit(False)))
            .orderBy(F.col("z_score").desc_nulls_last(), "seller_id"))


def flagged_sellers(zscores: DataFrame, top_n: int | None = 5) -> DataFrame:
    """TOP3: flagged sellers by z descending (late sellers first)."""
    f = zscores.filter("is_anomalous").orderBy(F.col("z_score").desc_nulls_last(), "seller_id")
    return f.limit(top_n) if top_n is not None else f


def top_zscore_sellers(zscores: DataFrame, n: int = 10) -> DataFrame:
    """TOP5: highest z, flagged or not."""
    return zscores.orderBy(F.col("z_score").desc_nulls_last(), "seller_id").limit(n)


def zscore_counts(zscores: DataFrame) -> DataFrame:
    """DB4: sellers evaluated and flagged."""
    return zscores.agg(F.count(F.lit(1)).alias("sellers_evaluated"),
                       F.count_if("is_anomalous").alias("sellers_flagged"))


# ---------------------------------------------------------- correlation
# The names of the reported correlations.
CORR_PAIRS = [("installments_vs_delay_corr", "payment_installments", DELAY),
              ("freight_vs_delay_corr", "total_freight", DELAY),
              ("delay_vs_review_corr", DELAY, "review_score")]


def pearson(x: str, y: str):
    """Sample Pearson r; NULL (not an error) when either side is constant."""
    cx, cy = F.col(x).cast("double"), F.col(y).cast("double")
    return F.try_divide(F.covar_samp(cx, cy), F.stddev_samp(cx) * F.stddev_samp(cy))


def delay_correlations(fact: DataFrame, decimals: int = 3) -> DataFrame:
    """ST4/AGG17 over complete cases of the four columns, one aggregate pass."""
    cols = [DELAY, "payment_installments", "total_freight", "review_score"]
    d = fact.dropna(subset=cols)
    return d.agg(*[r2(pearson(x, y), decimals).alias(name) for name, x, y in CORR_PAIRS])


# ------------------------------------------------------------ histogram
def delay_histogram(fact: DataFrame, bins: int = 60, lo: float = -40.0, hi: float = 40.0) -> DataFrame:
    """AGG18: delivered orders' delay clipped to [lo, hi], ``bins`` equal-width
    bins over the observed clipped range (last edge inclusive), all bins
    reported (empty ones with 0). Bin edges come from one scalar subquery."""
    x = (fact.filter((F.col("order_status") == "delivered") & F.col(DELAY).isNotNull())
         .select(clip(DELAY, lo, hi).alias("x")))
    # the observed range is one row, attached once as a column on each side
    rng = x.select(F.struct(F.min("x").alias("a"), F.max("x").alias("b"))).scalar()
    a, b = F.col("_r.a"), F.col("_r.b")
    width = F.when(b > a, b - a)
    idx = F.when(width.isNull(), F.lit(1)).otherwise(
        F.least(F.floor((F.col("x") - a) * bins / width), F.lit(bins - 1)) + 1)
    counts = (x.withColumn("_r", rng).groupBy(idx.cast("int").alias("bin"))
              .agg(F.count(F.lit(1)).alias("order_count")))
    w = F.coalesce(width, F.lit(0.0))
    edges = (counts.agg(F.count(F.lit(1)).alias("_one")).withColumn("_r", rng)
             .filter(a.isNotNull())
             .select("_r", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin")))
    return (edges.join(counts, "bin", "left")
            .select("bin",
                    (a + (F.col("bin") - 1) * w / bins).alias("bin_lo"),
                    (a + F.col("bin") * w / bins).alias("bin_hi"),
                    F.coalesce("order_count", F.lit(0)).alias("order_count")))
