-- Sellers with at least :min_orders single-seller orders and their unrounded
-- on-time ratio. Orders are summed per seller before they meet the dimension, so a
-- heavy seller joins as one row. The runner attaches worst_on_time_rank = RANK() over
-- the ratio ascending (a seller without any SLA outcome ranks first) with the
-- distributed rank operator, so no step holds all sellers in one task.
WITH per_seller AS (
  SELECT seller_id, count(*) AS orders, count_if(on_time_flag = 1) AS on_time, count(on_time_flag) AS sla,
         sum(delivery_delay_days) AS delay, count(delivery_delay_days) AS delays,
         sum(review_score) AS score, count(review_score) AS scores
  FROM fact_orders
  WHERE n_sellers = 1
  GROUP BY seller_id
), summed AS (
  SELECT s.seller_id, s.state, sum(p.orders) AS orders, sum(p.on_time) AS on_time, sum(p.sla) AS sla,
         try_divide(sum(p.delay), sum(p.delays)) AS delay, try_divide(sum(p.score), sum(p.scores)) AS score
  FROM per_seller AS p
  INNER JOIN dim_seller AS s ON p.seller_id = s.seller_id
  GROUP BY s.seller_id, s.state
)
SELECT seller_id, state                                            AS seller_state,
       orders                                                      AS order_count,
       try_divide(100.0D * on_time, sla)                           AS on_time_ratio,
       round(round(try_divide(100.0D * on_time, sla), 12), 2)      AS on_time_pct,
       round(round(delay, 12), 2)                                  AS avg_delay_days,
       round(round(score, 12), 2)                                  AS avg_review_score
FROM summed
WHERE orders >= :min_orders
