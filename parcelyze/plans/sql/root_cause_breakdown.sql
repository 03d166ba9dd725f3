-- Stage averages for one seller's single-seller orders (bound parameter :seller_id).
SELECT seller_id, count(*) AS order_count,
       round(round(avg(processing_days), 12), 2)     AS avg_processing_days,
       round(round(avg(carrier_pickup_days), 12), 2) AS avg_carrier_pickup_days,
       round(round(avg(shipping_days), 12), 2)       AS avg_shipping_days,
       round(round(avg(delivery_delay_days), 12), 2) AS avg_delay_days
FROM fact_orders
WHERE seller_id = :seller_id AND n_sellers = 1
GROUP BY seller_id
