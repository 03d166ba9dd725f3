-- Seller-months whose mean delay exceeds the mean of the seller's previous three
-- qualifying months (rows, so gaps are skipped) by more than :threshold days.
-- A seller's qualifying months are one short array; a month looks back in it.
SELECT seller_id, now.year_month, now.orders AS order_count,
       round(round(now.delay, 12), 2)          AS avg_delay_days,
       round(round(usual, 12), 2)              AS rolling_baseline_delay,
       round(round(now.delay - usual, 12), 2)  AS delay_deviation
FROM (
  SELECT seller_id, now,
         aggregate(slice(months, greatest(place - 2, 1), least(place, 3)), 0D,
                   (total, month) -> total + month.delay, total -> total / least(place, 3)) AS usual
  FROM (
    SELECT seller_id, array_sort(collect_list(month)) AS months
    FROM (
      SELECT seller_id, struct(calendar.month AS year_month, count(*) AS orders, avg(delivery_delay_days) AS delay) AS month
      FROM fact_orders JOIN (SELECT date_key, year_month AS month FROM dim_date) AS calendar USING (date_key)
      WHERE n_sellers = 1 AND isnotnull(delivery_delay_days)
      GROUP BY seller_id, calendar.month
    ) WHERE month.orders >= :min_orders
    GROUP BY seller_id
  ) LATERAL VIEW posexplode(months) AS place, now
  WHERE place > 0
)
WHERE now.delay - usual > :threshold
ORDER BY delay_deviation DESC, seller_id, year_month
