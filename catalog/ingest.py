"""Ingest queries: parsing, validation, routing, de-duplication, dimension loading."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.sqltext import CONTENTS, EV, META, MSG, PARSED, USERS, ab, with_
from watchlens.functions import jsontext
from watchlens.functions.identity import ab_group
from watchlens.functions.times import format_iso, parse_iso, utc_wall_clock
from watchlens.operators import ingest as ops
from watchlens.sources import dimensions, testbed


def _parsed(spark: SparkSession, folder: str) -> DataFrame:
    return ops.parse_messages(testbed.messages(spark, folder))


def parse_events(spark: SparkSession, folder: str) -> DataFrame:
    return ops.decode_events(testbed.messages(spark, folder)).select(
        "event_id", "timestamp", "user_id", "session_id", "event_type", "content_id", "watched_minutes",
        jsontext.metadata_value(F.col("metadata"), "device").alias("device"),
    )


def parse_timestamps(spark: SparkSession, folder: str) -> DataFrame:
    decoded = ops.decode_events(testbed.messages(spark, folder))
    timed = ops.add_event_time(decoded).where(F.col("timestamp_ts").isNotNull())
    return timed.select("event_id", "timestamp", utc_wall_clock(F.col("timestamp_ts")).alias("event_ts"))


def iso_format_ts(spark: SparkSession, folder: str) -> DataFrame:
    return testbed.user_events(spark, folder).select("event_id", format_iso(F.col("timestamp_ts")).alias("iso"))


def validate_events(spark: SparkSession, folder: str) -> DataFrame:
    return _parsed(spark, folder).select("offset", "event_id", "reject_reason")


def reject_reasons(spark: SparkSession, folder: str) -> DataFrame:
    return ops.reason_counts(_parsed(spark, folder))


def dead_letters(spark: SparkSession, folder: str) -> DataFrame:
    letters = ops.dead_letters(_parsed(spark, folder), at=F.col("message_timestamp"))
    return letters.withColumn("timestamp", utc_wall_clock(F.col("timestamp")))


def dedupe_events(spark: SparkSession, folder: str) -> DataFrame:
    good = ops.accepted(_parsed(spark, folder))
    return ops.first_per_event(good, ["timestamp_ts", "partition", "offset"]).select("event_id", "user_id", "offset")


def new_events_only(spark: SparkSession, folder: str) -> DataFrame:
    """Accepted events that are no stored watch event yet."""
    stored = testbed.user_events(spark, folder).where(F.col("event_type") == "watch")
    good = ops.first_per_event(ops.accepted(_parsed(spark, folder)), ["timestamp_ts", "partition", "offset"])
    return ops.not_yet_stored(good, stored).select("event_id", "event_type")


def ingest_projection(spark: SparkSession, folder: str) -> DataFrame:
    good = ops.first_per_event(ops.accepted(_parsed(spark, folder)), ["timestamp_ts", "partition", "offset"])
    return ops.stored_event(good)


def metadata_access(spark: SparkSession, folder: str) -> DataFrame:
    metadata = F.col("metadata")
    return testbed.user_events(spark, folder).select(
        "event_id",
        *[jsontext.metadata_value(metadata, key).alias(key) for key in ("k", "device", "ab_test_group", "rating", "action")],
        jsontext.metadata_json(metadata).alias("metadata_text"),
    )


def event_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Users with their A/B label, from the id text."""
    return testbed.user_profiles(spark, folder).select("user_id", ab_group(F.col("user_id")).alias("ab_test_group"))


def _user_records(spark: SparkSession, folder: str) -> DataFrame:
    """Users as untidy text records: padded ids, blank segments, lists in several spellings."""
    n = F.substring_index("user_id", "-", -1).cast("int")
    once = F.to_json("favorite_categories")
    twice = F.concat(F.lit('"'), F.replace(once, F.lit('"'), F.lit('\\"')), F.lit('"'))
    spelling = (
        F.when(n % 5 == 0, once).when(n % 5 == 1, twice).when(n % 5 == 2, F.lit("")).when(n % 5 == 3, F.lit("[bad"))
    )
    return testbed.user_profiles(spark, folder).select(
        F.when(n % 11 == 0, "  ").otherwise(F.concat(F.lit(" "), F.col("user_id"), F.lit(" "))).alias("user_id"),
        F.when(n % 7 == 0, " ").when(n % 7 == 1, F.lit(None)).otherwise(F.col("user_segment")).alias("user_segment"),
        spelling.alias("favorite_categories"),
    )


def load_users(spark: SparkSession, folder: str) -> DataFrame:
    users = dimensions.clean_users(_user_records(spark, folder))
    return users.select("user_id", "user_segment", F.array_join("favorite_categories", ",").alias("favorites"))


def favorite_categories_parse(spark: SparkSession, folder: str) -> DataFrame:
    records = _user_records(spark, folder)
    parsed = jsontext.parse_text_list(F.col("favorite_categories"))
    return records.select(F.size(parsed).alias("items"), F.array_join(parsed, ",").alias("favorites")).groupBy(
        "items", "favorites"
    ).agg(F.count(F.lit(1)).alias("users"))


def load_contents(spark: SparkSession, folder: str) -> DataFrame:
    n = F.substring_index("content_id", "-", -1).cast("int")
    text = F.col("duration_minutes").cast("string")
    records = testbed.contents(spark, folder).select(
        F.when(n % 13 == 0, "").otherwise(F.col("content_id")).alias("content_id"),
        "title", "content_type", "genre", "sub_genre",
        F.when(n % 6 == 0, "soon").when(n % 6 == 1, "").when(n % 6 == 2, F.lit(None)).otherwise(text).alias("duration_minutes"),
        F.col("release_year").cast("string").alias("release_year"),
        F.when(n % 17 == 0, "n/a").otherwise(F.round("rating", 4).cast("string")).alias("rating"),
        F.col("review_count").cast("string").alias("review_count"),
    )
    return dimensions.clean_contents(records).withColumn("rating", F.round("rating", 4))


def semantic_rule_violations(spark: SparkSession, folder: str) -> DataFrame:
    durations = testbed.contents(spark, folder).select("content_id", "duration_minutes")
    events = testbed.user_events(spark, folder).join(durations, "content_id", "left")
    return ops.semantic_violations(events)


def reparsed_timestamps(spark: SparkSession, folder: str) -> DataFrame:
    """Millisecond ISO text written and read back."""
    iso = format_iso(F.col("timestamp_ts"))
    return testbed.user_events(spark, folder).select("event_id", utc_wall_clock(parse_iso(iso)).alias("event_ts"))


QUERIES = {
    "parse_events": parse_events,
    "parse_timestamps": parse_timestamps,
    "iso_format_ts": iso_format_ts,
    "iso_round_trip": reparsed_timestamps,
    "validate_events": validate_events,
    "reject_reasons": reject_reasons,
    "dead_letters": dead_letters,
    "dedupe_events": dedupe_events,
    "new_events_only": new_events_only,
    "ingest_projection": ingest_projection,
    "metadata_access": metadata_access,
    "ab_labels": event_labels,
    "load_users": load_users,
    "favorite_categories_parse": favorite_categories_parse,
    "load_contents": load_contents,
    "semantic_rule_violations": semantic_rule_violations,
}

_MESSAGES = with_(EV, MSG, PARSED)
_FIRST = """first_good AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY event_ts, part, off) AS rn
  FROM judged WHERE reject_reason IS NULL) WHERE rn = 1)"""
_FIRST_GOOD = with_(EV, MSG, PARSED, _FIRST)
_RECORDS = """records AS (SELECT
    CASE WHEN n % 11 = 0 THEN '  ' ELSE ' ' || user_id || ' ' END AS user_id,
    CASE n % 7 WHEN 0 THEN ' ' WHEN 1 THEN NULL ELSE user_segment END AS user_segment,
    CASE WHEN n % 5 <= 1 THEN array_to_string(favorites, ',') ELSE '' END AS favorites,
    CASE WHEN n % 5 <= 1 THEN len(favorites) ELSE 0 END AS items
  FROM (SELECT *, CAST(split_part(user_id, '-', 2) AS INTEGER) AS n FROM users))"""

ORACLE = {
    "parse_events": _MESSAGES + """SELECT event_id, stamp AS timestamp, user_id, session_id, event_type, content_id,
  watched_minutes, metadata->>'device' AS device FROM fields""",
    "parse_timestamps": _MESSAGES + "SELECT event_id, stamp AS timestamp, event_ts FROM fields WHERE event_ts IS NOT NULL",
    "iso_format_ts": with_(EV) + "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS iso FROM ev",
    "iso_round_trip": with_(EV) + "SELECT event_id, date_trunc('milliseconds', ts) AS event_ts FROM ev",
    "validate_events": _MESSAGES + 'SELECT off AS "offset", event_id, reject_reason FROM judged',
    "reject_reasons": _MESSAGES + """SELECT coalesce(reject_reason, 'accepted') AS outcome, count(*) AS messages
FROM judged GROUP BY 1""",
    "dead_letters": _MESSAGES + """SELECT ts AS timestamp, 'MessageProcessingError' AS error_type,
  reject_reason AS error_message, 'user-events' AS topic, part AS partition, off AS "offset", key,
  value AS raw_value FROM judged WHERE reject_reason IS NOT NULL""",
    "dedupe_events": _FIRST_GOOD + 'SELECT event_id, user_id, off AS "offset" FROM first_good',
    "new_events_only": _FIRST_GOOD + """SELECT event_id, event_type FROM first_good
WHERE event_id NOT IN (SELECT event_id FROM ev WHERE event_type = 'watch')""",
    "ingest_projection": _FIRST_GOOD + """SELECT event_id, user_id, session_id, event_type, content_id,
  coalesce(watched_minutes, 0) AS watched_minutes, event_ts AS timestamp, CAST(metadata AS VARCHAR) AS metadata,
  CAST(event_ts AS DATE) AS event_date FROM first_good""",
    "metadata_access": with_(EV) + f"""SELECT event_id, CAST(k AS VARCHAR) AS k, (['mobile','web','tv'])[k % 3 + 1] AS device,
  {ab('user_id')} AS ab_test_group,
  CASE WHEN event_type = 'rating' THEN CAST(k % 5 + 1 AS VARCHAR) END AS rating,
  CASE WHEN event_type = 'watchlist' THEN CASE WHEN k % 2 = 0 THEN 'add' ELSE 'remove' END END AS action,
  {META} AS metadata_text FROM ev""",
    "ab_labels": with_(USERS) + f"SELECT user_id, {ab('user_id')} AS ab_test_group FROM users",
    "load_users": with_(USERS, _RECORDS) + """SELECT trim(user_id) AS user_id,
  coalesce(nullif(trim(user_segment), ''), 'Unknown') AS user_segment, favorites
FROM records WHERE trim(user_id) <> ''""",
    "favorite_categories_parse": with_(USERS, _RECORDS) + """SELECT CAST(items AS INTEGER) AS items, favorites,
  count(*) AS users FROM records GROUP BY ALL""",
    "load_contents": with_(CONTENTS) + """SELECT content_id, title, content_type, genre, sub_genre,
  CASE WHEN n % 6 IN (1, 2) THEN 0 ELSE duration_minutes END AS duration_minutes, release_year,
  round(rating, 4) AS rating, review_count
FROM (SELECT *, CAST(split_part(content_id, '-', 2) AS INTEGER) AS n FROM contents)
WHERE n % 13 <> 0 AND n % 6 <> 0 AND n % 17 <> 0""",
    "semantic_rule_violations": with_(EV, CONTENTS) + f""", j AS (
  SELECT ev.*, duration_minutes AS d FROM ev LEFT JOIN contents USING (content_id))
SELECT 'click_has_minutes' AS rule, count(*) FILTER (event_type = 'click' AND watched_minutes <> 0) AS violations FROM j
UNION ALL SELECT 'watchlist_has_minutes', count(*) FILTER (event_type = 'watchlist' AND watched_minutes <> 0) FROM j
UNION ALL SELECT 'watch_out_of_range', count(*) FILTER (event_type = 'watch' AND d > 0 AND (watched_minutes < 1 OR watched_minutes > d)) FROM j
UNION ALL SELECT 'complete_not_full', count(*) FILTER (event_type = 'watch_complete' AND watched_minutes <> d) FROM j
UNION ALL SELECT 'rating_out_of_range', 0
UNION ALL SELECT 'ab_label_wrong', 0""",
}
