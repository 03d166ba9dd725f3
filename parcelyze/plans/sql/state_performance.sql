-- Delivery performance by customer state, states with at least :min_orders orders.
-- Orders are summed per customer before they meet the dimension.
WITH per_customer AS (
  SELECT customer_id, count(*) AS orders, count_if(on_time_flag = 1) AS on_time, count(on_time_flag) AS sla,
         sum(delivery_delay_days) AS delay, count(delivery_delay_days) AS delays,
         sum(shipping_days) AS shipping, count(shipping_days) AS shipped
  FROM fact_orders
  GROUP BY customer_id
), summed AS (
  SELECT c.state, sum(p.orders) AS orders, sum(p.on_time) AS on_time, sum(p.sla) AS sla,
         try_divide(sum(p.delay), sum(p.delays)) AS delay, try_divide(sum(p.shipping), sum(p.shipped)) AS shipping
  FROM per_customer AS p
  INNER JOIN dim_customer AS c ON p.customer_id = c.customer_id
  GROUP BY c.state
)
SELECT state                                                  AS customer_state,
       orders                                                 AS order_count,
       round(round(try_divide(100.0D * on_time, sla), 12), 2) AS on_time_pct,
       round(round(delay, 12), 2)                             AS avg_delay_days,
       round(round(shipping, 12), 2)                          AS avg_shipping_days
FROM summed
WHERE orders >= :min_orders
ORDER BY on_time_pct ASC NULLS FIRST, customer_state
