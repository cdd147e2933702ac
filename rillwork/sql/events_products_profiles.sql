-- Three-way join. The event keeps its own columns; profiles hold one row per user.
SELECT e.event_id, e.user_id, e.event_type, e.product_id, e.event_time,
       p.product_name, p.category, u.username, u.user_segment
FROM user_events AS e
LEFT OUTER JOIN product_updates AS p
  ON p.product_id = e.product_id AND p.window_start = e.window_start
LEFT OUTER JOIN user_profiles AS u ON u.user_id = e.user_id
