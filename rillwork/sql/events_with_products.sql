-- Events with the product updates of the same window. Both inputs carry their window start.
SELECT e.event_id, e.user_id, e.event_type, e.event_time AS event_timestamp,
       p.product_id, p.product_name, p.price, p.category
FROM user_events AS e
LEFT OUTER JOIN product_updates AS p
  ON p.product_id = e.product_id AND p.window_start = e.window_start
