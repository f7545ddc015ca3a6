"""Building blocks of the check SQL: the engine's tables as common table expressions."""

from __future__ import annotations

CODE_SUM = "list_sum(list_transform(string_split({u}, ''), lambda c: unicode(c)))"


def ab(user: str) -> str:
    return f"CASE WHEN {CODE_SUM.format(u=user)} % 2 = 0 THEN 'A' ELSE 'B' END"


EV = f"""ev AS (
  SELECT 'evt-' || event_id AS event_id, event_id AS id,
         printf('user-%05d', user_id) AS user_id,
         printf('user-%05d', user_id) || '-sess-' || strftime(ts, '%Y%m%d') AS session_id,
         CASE event_type WHEN 'view' THEN 'watch' WHEN 'purchase' THEN 'watch_complete'
              WHEN 'signup' THEN 'watchlist' WHEN 'error' THEN 'rating' ELSE event_type END AS event_type,
         'content-' || json_extract_string(props, '$.k') AS content_id,
         CAST(floor(value) AS INTEGER) AS watched_minutes, ts,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events)"""

USERS = """users AS (
  SELECT printf('user-%05d', c_custkey) AS user_id,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'VIP' WHEN 'FURNITURE' THEN 'Regular'
              WHEN 'MACHINERY' THEN 'Regular' ELSE 'New' END AS user_segment,
         CAST(DATE '2020-01-01' + CAST(c_custkey % 2000 AS INTEGER) AS DATE) AS signup_date,
         CAST(c_custkey % 100 AS INTEGER) AS total_purchases,
         CAST(c_acctbal AS DECIMAL(12,2)) AS total_spent,
         CASE WHEN c_custkey % 6 = (c_custkey * 5 + 2) % 6 THEN [g[c_custkey % 6 + 1]]
              ELSE [g[c_custkey % 6 + 1], g[(c_custkey * 5 + 2) % 6 + 1]] END AS favorites
  FROM customer, (SELECT ['ECONOMY','SMALL','MEDIUM','PROMO','STANDARD','LARGE'] AS g))"""

CONTENTS = """contents AS (
  SELECT 'content-' || p_partkey AS content_id, p_name AS title,
         CASE p_type WHEN 'ECONOMY' THEN 'movie' WHEN 'SMALL' THEN 'movie' WHEN 'MEDIUM' THEN 'movie'
              WHEN 'PROMO' THEN 'series' WHEN 'STANDARD' THEN 'series' ELSE 'documentary' END AS content_type,
         p_type AS genre, p_brand AS sub_genre, p_size AS duration_minutes,
         CAST(p_partkey % 36 + 1990 AS INTEGER) AS release_year,
         p_retailprice % 5 * 0.8 + 1 AS rating,
         CAST(p_partkey * 37 % 50000 AS INTEGER) AS review_count
  FROM part)"""

RECS = f"""recs AS (
  SELECT user_id, content_id, created_at, score AS recommendation_score, {ab('user_id')} AS ab_test_group,
         CASE WHEN {ab('user_id')} = 'A' THEN 'collaborative_filtering' ELSE 'session_based' END AS algorithm
  FROM (SELECT printf('user-%05d', o_custkey) AS user_id, 'content-' || (l_partkey % 100) AS content_id,
               TIMESTAMP '2024-01-01' + to_hours(CAST(l_orderkey % 600 AS INTEGER)) AS created_at,
               max(l_quantity / 50) AS score
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3))"""

META = """'{"k":"' || k || '","ab_test_group":"' || """ + ab("user_id") + """ || '","device":"' ||
  (['mobile','web','tv'])[k % 3 + 1] || '"' ||
  CASE event_type WHEN 'rating' THEN ',"rating":"' || (k % 5 + 1) || '"'
       WHEN 'watchlist' THEN ',"action":"' || (CASE WHEN k % 2 = 0 THEN 'add' ELSE 'remove' END) || '"'
       ELSE '' END || '}'"""

#: Raw messages, written out as text from the columns.
MSG = f"""parts AS (
  SELECT ev.*, id % 20 AS damage,
    CASE id % 20 WHEN 9 THEN 'not-a-time'
      WHEN 10 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
      WHEN 11 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'
      WHEN 12 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z'
      ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' END AS stamp,
    {META} AS meta
  FROM ev),
bodies AS (
  SELECT *, '{{"event_id":"' || event_id || '","timestamp":"' || stamp || '"'
    || CASE WHEN damage = 1 THEN '' ELSE ',"user_id":"' || user_id || '"' END
    || ',"session_id":"' || session_id || '","event_type":"'
    || CASE WHEN damage = 2 THEN 'paused' ELSE event_type END
    || '","content_id":"' || CASE WHEN damage = 3 THEN '' ELSE content_id END
    || '","watched_minutes":' || watched_minutes || ',"metadata":' || meta || '}}' AS body
  FROM parts),
msg AS (
  SELECT CASE damage WHEN 0 THEN '!' || body WHEN 4 THEN 'null' WHEN 5 THEN '[' || body || ']'
              WHEN 6 THEN '42' WHEN 7 THEN '{{}}' ELSE body END AS value,
         user_id AS key, CAST(id % 3 AS INTEGER) AS part, id * 2 + copy AS off, ts
  FROM bodies, (SELECT 0 AS copy UNION ALL SELECT 1) WHERE copy = 0 OR damage = 8)"""

#: Messages taken apart with DuckDB's own JSON functions.
PARSED = """parsed AS (
  SELECT *, json_valid(value) AS ok,
    CASE WHEN json_valid(value) AND json_type(value) = 'OBJECT' THEN CAST(value AS JSON) END AS obj
  FROM msg),
fields AS (
  SELECT *, obj->>'event_id' AS event_id, obj->>'timestamp' AS stamp, obj->>'user_id' AS user_id,
    obj->>'session_id' AS session_id, obj->>'event_type' AS event_type, obj->>'content_id' AS content_id,
    TRY_CAST(obj->>'watched_minutes' AS INTEGER) AS watched_minutes, obj->'metadata' AS metadata,
    TRY_CAST(obj->>'timestamp' AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS event_ts
  FROM parsed),
judged AS (
  SELECT *, CASE WHEN NOT ok THEN 'bad_json' WHEN obj IS NULL THEN 'not_object'
    WHEN len(missing) > 0 THEN 'missing:' || array_to_string(missing, ',')
    WHEN event_type NOT IN ('click','watch','watchlist','watch_complete','rating') THEN 'bad_event_type'
    WHEN event_ts IS NULL THEN 'bad_timestamp' END AS reject_reason
  FROM (SELECT *, list_filter([
      CASE WHEN coalesce(event_id, '') = '' THEN 'event_id' END,
      CASE WHEN coalesce(stamp, '') = '' THEN 'timestamp' END,
      CASE WHEN coalesce(user_id, '') = '' THEN 'user_id' END,
      CASE WHEN coalesce(session_id, '') = '' THEN 'session_id' END,
      CASE WHEN coalesce(event_type, '') = '' THEN 'event_type' END,
      CASE WHEN coalesce(content_id, '') = '' THEN 'content_id' END], lambda x: x IS NOT NULL) AS missing
    FROM fields))"""


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"
