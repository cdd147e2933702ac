-- Events per type and one-minute window.
WITH placed AS (
  SELECT event_type, window(event_time, '1 minute') AS w
  FROM PCOLLECTION
)
SELECT event_type, count(1) AS event_count, w.start AS window_start, w.end AS window_end
FROM placed
GROUP BY event_type, w
