"""Statistics queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.sqltext import CONTENTS, EV, USERS, with_
from watchlens.functions.identity import pseudonym
from watchlens.operators import stats as ops
from watchlens.session import materialize
from watchlens.sources import testbed


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return testbed.user_events(spark, folder)


def table_counts(spark: SparkSession, folder: str) -> DataFrame:
    tables = {
        "user_events": testbed.user_events, "user_profiles": testbed.user_profiles, "contents": testbed.contents,
    }
    counts = [
        ops.count_by(read(spark, folder)).select(F.lit(name).alias("table_name"), "rows")
        for name, read in tables.items()
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def enrich_events(spark: SparkSession, folder: str) -> DataFrame:
    enriched = ops.enrich(_events(spark, folder), testbed.user_profiles(spark, folder), testbed.contents(spark, folder))
    return enriched.select("event_id", "user_segment", "title", "genre", "content_type", "duration_minutes")


def segment_weighted_minutes(spark: SparkSession, folder: str) -> DataFrame:
    weighted = ops.segment_weighted(_events(spark, folder), testbed.user_profiles(spark, folder))
    return weighted.withColumn("weighted_minutes", F.round("weighted_minutes", 6))


def moving_average(spark: SparkSession, folder: str) -> DataFrame:
    series = ops.activity(_events(spark, folder), "event_type")
    averaged = ops.moving_average(series, "event_type", 3)
    return averaged.withColumn("moving_average", F.round("moving_average", 6))


def daily_viewers(spark: SparkSession, folder: str) -> DataFrame:
    """Days of contents whose viewers, merged from stored hourly sketches, are within 2 % of the exact number."""
    events = _events(spark, folder)
    hourly = materialize(ops.viewer_sketches(events), "viewer-sketches")
    merged = ops.merged_viewers(hourly, "day")
    exact = ops.heat_map(events, "1 day", approximate=False).withColumnsRenamed({"viewers": "exact", "views": "v", "minutes": "m"})
    near = F.abs(F.col("viewers") - F.col("exact")) <= F.greatest(F.lit(0.02) * F.col("exact"), F.lit(0.5))
    return merged.join(exact, ["content_id", "bucket_start"]).select(
        "content_id", "bucket_start", "views", "minutes", near.alias("within_2_percent")
    )


def rewatches(spark: SparkSession, folder: str) -> DataFrame:
    return ops.rewatches(_events(spark, folder)).select("event_id", "viewing", "is_rewatch")


def user_card(spark: SparkSession, folder: str) -> DataFrame:
    card = ops.user_card(testbed.user_profiles(spark, folder), _events(spark, folder))
    return card.select("user_id", "user_segment", "total_purchases", "events", "watched_minutes", "last_seen")


def anonymize_users(spark: SparkSession, folder: str) -> DataFrame:
    return testbed.user_profiles(spark, folder).select(
        pseudonym(F.col("user_id"), "pepper:").alias("user_key"), "user_segment"
    )


def _on_events(operator):
    return lambda spark, folder: operator(_events(spark, folder))


def _on_some(operator):
    """On a catalogue in which contents are missing."""
    return lambda spark, folder: operator(_events(spark, folder), testbed.without_some(testbed.contents(spark, folder)))


def _on_both(operator):
    return lambda spark, folder: operator(_events(spark, folder), testbed.contents(spark, folder))


QUERIES = {
    "user_stats": lambda spark, folder: ops.user_statistics(testbed.user_profiles(spark, folder)),
    "segment_counts": lambda spark, folder: ops.count_by(testbed.user_profiles(spark, folder), "user_segment", name="users"),
    "content_stats": lambda spark, folder: ops.content_statistics(testbed.contents(spark, folder)),
    "type_counts": lambda spark, folder: ops.count_by(testbed.contents(spark, folder), "content_type", name="contents"),
    "type_shares": lambda spark, folder: ops.shares(testbed.contents(spark, folder), "content_type"),
    "top5_genres": lambda spark, folder: ops.top_genres(testbed.contents(spark, folder)),
    "table_counts": table_counts,
    "session_event_counts": _on_events(lambda events: ops.count_by(events, "session_id", name="events")),
    "enrich_events": enrich_events,
    "event_transitions": _on_events(ops.event_transitions),
    "segment_weighted_minutes": segment_weighted_minutes,
    "user_event_pivot": _on_events(ops.events_by_type),
    "genre_hour_cube": _on_both(ops.genre_hour_cube),
    "watch_heatmap": _on_events(ops.heat_map),
    "moving_average": moving_average,
    "genre_preference": _on_both(ops.genre_preference),
    "genre_preference_some": _on_some(ops.genre_preference),
    "completion_dropoff": _on_both(ops.drop_off),
    "completion_dropoff_some": _on_some(ops.drop_off),
    "daily_viewers": daily_viewers,
    "event_sample": _on_events(lambda events: ops.hash_sample(events, 5, "event_id", ["event_type"]).select("event_type", "event_id", "place")),
    "rating_summary": _on_events(ops.rating_summary),
    "rewatches": rewatches,
    "current_watchlist": _on_events(ops.current_watchlist),
    "user_card": user_card,
    "watch_history": _on_events(ops.watch_history),
    "anonymize_users": anonymize_users,
}

_JOINED = with_(EV, CONTENTS)
_SOME = with_(EV, CONTENTS, "catalogue AS (SELECT * FROM contents WHERE CAST(split_part(content_id, '-', 2) AS INTEGER) % 7 <> 0)")

_GENRES = """SELECT *, round(events / sum(events) OVER (PARTITION BY user_id), 6) AS share FROM (
  SELECT user_id, coalesce(genre, 'Unknown') AS genre, count(*) AS events, CAST(sum(watched_minutes) AS BIGINT) AS minutes
  FROM ev LEFT JOIN catalogue USING (content_id) GROUP BY ALL)"""
_TENTHS = """SELECT content_id,
  CASE WHEN duration_minutes IS NOT NULL THEN CAST(least(floor(watched_minutes * 10 / duration_minutes), 10) AS INTEGER) END AS tenth, count(*) AS watches,
  round(avg(CASE WHEN duration_minutes IS NOT NULL THEN least(watched_minutes / duration_minutes, 1.0::DOUBLE) END), 6) AS mean_ratio
FROM ev LEFT JOIN (SELECT * FROM catalogue WHERE duration_minutes > 0) USING (content_id) WHERE event_type = 'watch' GROUP BY 1, 2"""
_ALL = with_(EV, CONTENTS, "catalogue AS (SELECT * FROM contents)")

ORACLE = {
    "genre_preference": _ALL + _GENRES,
    "completion_dropoff": _ALL + _TENTHS,
    "daily_viewers": with_(EV) + """SELECT content_id, date_trunc('day', ts)::TIMESTAMP AS bucket_start, count(*) AS views,
  CAST(sum(watched_minutes) AS BIGINT) AS minutes, true AS within_2_percent
FROM ev WHERE event_type IN ('watch', 'watch_complete') GROUP BY ALL""",
    "event_sample": with_(EV) + """SELECT event_type, event_id, CAST(place AS INTEGER) AS place FROM (
  SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY sha256(event_id)) AS place FROM ev) WHERE place <= 5""",
    "user_stats": with_(USERS) + """SELECT count(*) AS total_users, round(avg(total_purchases), 2) AS avg_purchases,
  round(CAST(sum(total_spent) AS DOUBLE) / count(*), 2) AS avg_spent,
  round(CAST(sum(total_spent) AS DOUBLE), 2) AS total_spent FROM users""",
    "segment_counts": with_(USERS) + "SELECT user_segment, count(*) AS users FROM users GROUP BY 1",
    "content_stats": with_(CONTENTS) + """SELECT count(*) AS total_contents, round(avg(rating), 2) AS avg_rating,
  round(avg(duration_minutes), 1) AS avg_duration FROM contents""",
    "type_counts": with_(CONTENTS) + "SELECT content_type, count(*) AS contents FROM contents GROUP BY 1",
    "type_shares": with_(CONTENTS) + """SELECT content_type, count(*) AS "rows",
  round(count(*) * 100.0 / (SELECT count(*) FROM contents), 2)::DOUBLE AS percent FROM contents GROUP BY 1""",
    "top5_genres": with_(CONTENTS) + """SELECT genre, count(*) AS contents FROM contents GROUP BY 1
ORDER BY contents DESC, genre LIMIT 5""",
    "table_counts": """SELECT 'user_events' AS table_name, count(*) AS "rows" FROM events
UNION ALL SELECT 'user_profiles', count(*) FROM customer UNION ALL SELECT 'contents', count(*) FROM part""",
    "session_event_counts": with_(EV) + "SELECT session_id, count(*) AS events FROM ev GROUP BY 1",
    "enrich_events": with_(EV, USERS, CONTENTS) + """SELECT event_id, user_segment, title, genre, content_type, duration_minutes
FROM ev LEFT JOIN users USING (user_id) LEFT JOIN contents USING (content_id)""",
    "event_transitions": with_(
        EV, "f AS (SELECT event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous_type FROM ev)",
        "c AS (SELECT previous_type, event_type, count(*) AS transitions FROM f WHERE previous_type IS NOT NULL GROUP BY ALL)",
    ) + """SELECT *, round(transitions / sum(transitions) OVER (PARTITION BY previous_type), 6) AS probability FROM c""",
    "segment_weighted_minutes": with_(EV, USERS) + """SELECT count(*) AS events,
  round(sum(w * watched_minutes) / sum(w), 6) AS weighted_minutes FROM (
  SELECT watched_minutes, CASE WHEN lower(user_segment) LIKE '%vip%' THEN 3.0::DOUBLE
    WHEN lower(user_segment) LIKE '%regular%' THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w FROM ev LEFT JOIN users USING (user_id))""",
    "user_event_pivot": with_(EV) + """SELECT user_id, count(*) FILTER (event_type = 'click') AS click_events,
  count(*) FILTER (event_type = 'watch') AS watch_events, count(*) FILTER (event_type = 'watchlist') AS watchlist_events,
  count(*) FILTER (event_type = 'watch_complete') AS watch_complete_events,
  count(*) FILTER (event_type = 'rating') AS rating_events, count(*) AS events FROM ev GROUP BY 1""",
    "genre_hour_cube": _JOINED + """SELECT genre, hour, count(*) AS events, CAST(sum(watched_minutes) AS BIGINT) AS minutes,
  CAST(grouping_id(genre, hour) AS INTEGER) AS level
FROM (SELECT coalesce(genre, 'Unknown') AS genre, CAST(hour(ts) AS INTEGER) AS hour, watched_minutes
      FROM ev LEFT JOIN contents USING (content_id)) GROUP BY CUBE (genre, hour)""",
    "watch_heatmap": with_(EV) + """SELECT content_id, date_trunc('hour', ts) AS bucket_start, count(*) AS views,
  count(DISTINCT user_id) AS viewers, CAST(sum(watched_minutes) AS BIGINT) AS minutes
FROM ev WHERE event_type IN ('watch', 'watch_complete') GROUP BY ALL""",
    "moving_average": with_(EV) + """SELECT *, round(avg(events) OVER (PARTITION BY event_type ORDER BY bucket_start
  ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS moving_average
FROM (SELECT event_type, date_trunc('hour', ts) AS bucket_start, count(*) AS events FROM ev GROUP BY ALL)""",
    "genre_preference_some": _SOME + _GENRES,
    "completion_dropoff_some": _SOME + _TENTHS,
    "rating_summary": with_(EV) + """SELECT content_id, count(*) AS ratings, round(avg(r), 6) AS mean_rating,
  count(*) FILTER (r = 1) AS rated_1, count(*) FILTER (r = 2) AS rated_2, count(*) FILTER (r = 3) AS rated_3,
  count(*) FILTER (r = 4) AS rated_4, count(*) FILTER (r = 5) AS rated_5
FROM (SELECT content_id, k % 5 + 1 AS r FROM ev WHERE event_type = 'rating') GROUP BY 1""",
    "rewatches": with_(EV) + """SELECT event_id, viewing, viewing > 1 AS is_rewatch FROM (
  SELECT event_id, row_number() OVER (PARTITION BY user_id, content_id ORDER BY ts, event_id) AS viewing
  FROM ev WHERE event_type IN ('watch', 'watch_complete'))""",
    "current_watchlist": with_(EV) + """SELECT user_id, content_id, ts AS added_at FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, content_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM ev WHERE event_type = 'watchlist') WHERE rn = 1 AND k % 2 = 0""",
    "user_card": with_(EV, USERS) + """SELECT user_id, user_segment, total_purchases, coalesce(events, 0) AS events,
  coalesce(watched_minutes, 0) AS watched_minutes, last_seen FROM users LEFT JOIN (
  SELECT user_id, count(*) AS events, CAST(sum(watched_minutes) AS BIGINT) AS watched_minutes, max(ts) AS last_seen
  FROM ev GROUP BY 1) USING (user_id)""",
    "watch_history": with_(EV) + """SELECT user_id, CAST(ts AS DATE) AS day, count(*) FILTER (event_type = 'watch') AS watches,
  count(*) FILTER (event_type = 'watch_complete') AS completions, CAST(sum(watched_minutes) AS BIGINT) AS minutes
FROM ev WHERE event_type IN ('watch', 'watch_complete') GROUP BY ALL""",
    "anonymize_users": with_(USERS) + "SELECT sha256('pepper:' || user_id) AS user_key, user_segment FROM users",
}
