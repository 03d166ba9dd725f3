"""Registered statistics queries (IQR, z-score, correlation, histogram) and twins."""

from __future__ import annotations


from pyspark.sql import functions as F

from ..functions.rules import r2
from ..operators import stats as S
from .oracle import R
from .registry import model, query

Z_DECIMALS = 6      # unrounded statistics are reported at 6 decimals

_IQR = {
    "_iq": """SELECT quantile_cont(delivery_delay_days, 0.25) AS q1,
                     quantile_cont(delivery_delay_days, 0.75) AS q3,
                     COUNT(delivery_delay_days) AS n FROM fact_orders""",
    "_ib": """SELECT q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_bound,
                     q3 + 1.5 * (q3 - q1) AS upper_bound, n FROM _iq""",
    "_io": """SELECT COUNT(*) AS n_outliers FROM fact_orders, _ib
              WHERE delivery_delay_days < lower_bound OR delivery_delay_days > upper_bound""",
    "_istats": f"""SELECT q1, q3, iqr, lower_bound, upper_bound, n_outliers,
                          {R('CAST(100.0 AS DOUBLE) * n_outliers / NULLIF(n, 0)')} AS pct_outliers
                   FROM _ib, _io""",
}
_Z = {
    "_sz": """SELECT seller_id, COUNT(order_id) AS order_count, AVG(delivery_delay_days) AS avg_delay,
                     AVG(review_score) AS avg_review
              FROM fact_orders WHERE n_sellers = 1 AND delivery_delay_days IS NOT NULL
                AND seller_id IS NOT NULL
              GROUP BY seller_id HAVING COUNT(order_id) >= 10""",
    "_zpop": "SELECT AVG(avg_delay) AS mu, STDDEV_SAMP(avg_delay) AS sigma FROM _sz",
    "_z": """SELECT s.*, (avg_delay - mu) / NULLIF(sigma, 0) AS z,
                    coalesce(abs((avg_delay - mu) / NULLIF(sigma, 0)) >= 1.5, false) AS is_anomalous
             FROM _sz s, _zpop""",
}
_CORR = {
    "_cc": """SELECT CAST(delivery_delay_days AS DOUBLE) AS d, CAST(payment_installments AS DOUBLE) AS i,
                     CAST(total_freight AS DOUBLE) AS f, CAST(review_score AS DOUBLE) AS r
              FROM fact_orders WHERE delivery_delay_days IS NOT NULL AND payment_installments IS NOT NULL
                AND total_freight IS NOT NULL AND review_score IS NOT NULL""",
    "_corr": f"""SELECT
        {R('covar_samp(i, d) / NULLIF(stddev_samp(i) * stddev_samp(d), 0)', 3)} AS installments_vs_delay_corr,
        {R('covar_samp(f, d) / NULLIF(stddev_samp(f) * stddev_samp(d), 0)', 3)} AS freight_vs_delay_corr,
        {R('covar_samp(d, r) / NULLIF(stddev_samp(d) * stddev_samp(r), 0)', 3)} AS delay_vs_review_corr
        FROM _cc""",
}


def _zsel(prefix=""):
    return (f"SELECT seller_id, order_count, {R('avg_delay', Z_DECIMALS)} AS avg_delay, "
            f"{R('avg_review', Z_DECIMALS)} AS avg_review, {R('z', Z_DECIMALS)} AS z_score, "
            f"is_anomalous FROM _z {prefix}")


def _zround(df):
    return df.select("seller_id", "order_count",
                     *[r2(c, Z_DECIMALS).alias(c) for c in ["avg_delay", "avg_review", "z_score"]],
                     "is_anomalous")


def _fact(spark, sf_dir):
    return model(spark, sf_dir).fact_orders


@query("iqr_bounds", "SELECT * FROM _istats", _IQR)
def q_iqr_bounds(spark, sf_dir):
    return S.iqr_stats(_fact(spark, sf_dir))


@query("iqr_outlier_orders", """
SELECT order_id, delivery_delay_days FROM fact_orders, _ib
WHERE delivery_delay_days < lower_bound OR delivery_delay_days > upper_bound""", _IQR)
def q_iqr_outlier_orders(spark, sf_dir):
    return S.iqr_outlier_rows(_fact(spark, sf_dir)).select("order_id", "delivery_delay_days")


@query("seller_zscore", _zsel(), _Z)
def q_seller_zscore(spark, sf_dir):
    return _zround(S.seller_zscore(_fact(spark, sf_dir)))


@query("top_zscore_sellers", _zsel("ORDER BY z DESC NULLS LAST, seller_id LIMIT 10"), _Z)
def q_top_zscore_sellers(spark, sf_dir):
    return _zround(S.top_zscore_sellers(S.seller_zscore(_fact(spark, sf_dir))))


@query("flagged_sellers", _zsel("WHERE is_anomalous ORDER BY z DESC NULLS LAST, seller_id LIMIT 5"), _Z)
def q_flagged_sellers(spark, sf_dir):
    return _zround(S.flagged_sellers(S.seller_zscore(_fact(spark, sf_dir)), 5))


@query("flagged_counts", """
SELECT COUNT(*) AS sellers_evaluated, COUNT(*) FILTER (WHERE is_anomalous) AS sellers_flagged FROM _z""", _Z)
def q_flagged_counts(spark, sf_dir):
    return S.zscore_counts(S.seller_zscore(_fact(spark, sf_dir)))


@query("delay_correlations", "SELECT * FROM _corr", _CORR)
def q_delay_correlations(spark, sf_dir):
    return S.delay_correlations(_fact(spark, sf_dir))


@query("delay_histogram", """
SELECT CAST(g.bin AS INTEGER) AS bin, a + (g.bin - 1) * coalesce(w, 0.0) / 60 AS bin_lo,
       a + g.bin * coalesce(w, 0.0) / 60 AS bin_hi, coalesce(c.n, 0) AS order_count
FROM (SELECT unnest(range(1, 61)) AS bin) g CROSS JOIN _hw
LEFT JOIN _hc c ON c.bin = g.bin
WHERE a IS NOT NULL""", {
    "_hx": """SELECT greatest(-40.0, least(40.0, delivery_delay_days)) AS x FROM fact_orders
              WHERE order_status = 'delivered' AND delivery_delay_days IS NOT NULL""",
    "_hw": "SELECT min(x) AS a, max(x) AS b, CASE WHEN max(x) > min(x) THEN max(x) - min(x) END AS w FROM _hx",
    "_hc": """SELECT CAST(CASE WHEN w IS NULL THEN 1 ELSE least(floor((x - a) * 60 / w), 59) + 1 END AS INTEGER)
                     AS bin, COUNT(*) AS n FROM _hx, _hw GROUP BY 1""",
})
def q_delay_histogram(spark, sf_dir):
    return S.delay_histogram(_fact(spark, sf_dir))


@query("delay_summary", """
SELECT s.*, (SELECT COUNT(*) FROM _z) AS sellers_evaluated,
       (SELECT COUNT(*) FROM _z WHERE is_anomalous) AS sellers_flagged, c.*
FROM _istats s, _corr c""", {**_IQR, **_Z, **_CORR})
def q_delay_summary(spark, sf_dir):
    f = _fact(spark, sf_dir)
    # one struct-valued scalar subquery per source, so each is computed once
    z = S.zscore_counts(S.seller_zscore(f)).select(F.struct("*")).scalar()
    corr = S.delay_correlations(f).select(F.struct("*")).scalar()
    return S.iqr_stats(f).select(
        "*", z.getField("sellers_evaluated").alias("sellers_evaluated"),
        z.getField("sellers_flagged").alias("sellers_flagged"),
        *[corr.getField(n).alias(n) for n, _, _ in S.CORR_PAIRS])
