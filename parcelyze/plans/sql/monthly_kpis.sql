-- Monthly delivery KPIs by purchase month (orders without a calendar day drop out).
-- Doubles are snapped to 12 decimals before HALF_UP rounding, as everywhere in the library.
SELECT d.year_month,
       count(*)                                            AS total_orders,
       count_if(f.order_status = 'delivered')              AS delivered_orders,
       round(round(try_divide(100.0D * count_if(f.on_time_flag = 1), count(f.on_time_flag)), 12), 2)
                                                           AS on_time_pct,
       round(round(avg(f.delivery_delay_days), 12), 2)     AS avg_delay_days,
       round(round(avg(f.review_score), 12), 2)            AS avg_review_score,
       CAST(round(sum(f.payment_value), 2) AS DOUBLE)      AS total_revenue
FROM fact_orders AS f
INNER JOIN dim_date AS d USING (date_key)
GROUP BY d.year_month
ORDER BY d.year_month
