"""The action tables over ``events``, as common table expressions (see oracle/sample.py)."""

TABLES = """
WITH dated AS (
  SELECT *, date_diff('day', CAST(ts AS DATE), DATE '2024-01-30') AS back FROM events),
moved AS (
  SELECT *, ts + (back - (CASE WHEN user_id % 3 = 2 THEN (user_id * 11) % 28 ELSE 0 END
      + (back * CASE user_id % 5 WHEN 2 THEN 10 WHEN 3 THEN 5 WHEN 4 THEN 270 ELSE 30 END) // 30))
      * INTERVAL 1 DAY AS time
  FROM dated),
actions AS (
  SELECT event_id, user_id, event_type, props, time, CAST(time AS DATE) AS day,
    CASE WHEN user_id % 10 = 9 THEN 'message' WHEN user_id % 10 = 4 THEN 'feed'
         WHEN event_type IN ('purchase', 'error') THEN 'message' ELSE 'feed' END AS service,
    CAST(user_id % 2 AS INT) AS gender,
    CASE WHEN user_id % 37 <> 11 THEN CAST(14 + (user_id * 7) % 50 AS INT) END AS age,
    'country-' || (user_id % 25) AS country,
    'country-' || (user_id % 25) || '-' || (user_id % 3) AS city,
    CASE WHEN user_id % 31 = 7 THEN NULL
         WHEN user_id % 11 = 0 AND CAST(time AS DATE) >= DATE '2024-01-20' THEN 'Web'
         WHEN user_id % 3 = 0 THEN 'iOS' ELSE 'Android' END AS os,
    CASE WHEN ((user_id // 3) % 5 < 2) <> (user_id % 13 = 4 AND event_id % 2 = 0)
         THEN 'ads' ELSE 'organic' END AS source,
    CAST(((user_id * 13) // 7 + CASE WHEN user_id % 29 = 3
          AND CAST(time AS DATE) >= DATE '2024-01-20' THEN 1 ELSE 0 END) % 5 AS INT) AS exp_group
  FROM moved),
feed AS (
  SELECT user_id, event_id AS post_id,
         CASE WHEN event_type = 'click' OR user_id % 17 = 5 THEN 'like' ELSE 'view' END AS action,
         time, day, gender, age, country, city, os, source, exp_group
  FROM actions WHERE service = 'feed'),
msg AS (
  SELECT user_id, abs(user_id + CAST(json_extract_string(props, '$.k') AS INT) - 50) AS receiver_id,
         time, day, gender, age, country, city, os, source, exp_group
  FROM actions WHERE service = 'message')
"""
