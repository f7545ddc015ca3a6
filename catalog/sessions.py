"""Session queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.sqltext import EV, USERS, with_
from watchlens.functions.jsontext import sorted_text
from watchlens.operators import sessions as ops
from watchlens.session import materialize
from watchlens.sources import testbed

LISTS = list(ops.LISTS)


def _readable(sessions: DataFrame) -> DataFrame:
    for name in LISTS:
        sessions = sessions.withColumn(name, sorted_text(F.col(name)))
    return sessions


def _windows(width: str):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return _readable(ops.session_windows(testbed.user_events(spark, folder), width))

    return query


def session_rollup(spark: SparkSession, folder: str) -> DataFrame:
    windows = ops.session_windows(testbed.user_events(spark, folder), "3 hours")
    return _readable(ops.session_rollup(windows))


def session_summary(spark: SparkSession, folder: str) -> DataFrame:
    return _readable(ops.session_summary(testbed.user_events(spark, folder)))


def analyze_session(spark: SparkSession, folder: str) -> DataFrame:
    return _readable(ops.analyze_session(testbed.user_events(spark, folder), "user-00007-sess-20240105"))


def session_table_rows(spark: SparkSession, folder: str) -> DataFrame:
    return ops.as_table_row(ops.session_windows(testbed.user_events(spark, folder), "3 hours"))


def session_length(spark: SparkSession, folder: str) -> DataFrame:
    lengths = ops.session_lengths(ops.session_summary(testbed.user_events(spark, folder)))
    for name in ("mean_seconds", "median_seconds", "events_per_session"):
        lengths = lengths.withColumn(name, F.round(name, 6))
    return lengths


def segment_lengths(spark: SparkSession, folder: str) -> DataFrame:
    """Sessions of each segment, and whether the median out of daily sketches has a rank within 2 % of the middle."""
    summary = materialize(ops.session_summary(testbed.user_events(spark, folder)), "session-summary")
    users = testbed.user_profiles(spark, folder).select("user_id", "user_segment")
    named = summary.join(users, "user_id", "left").withColumn("day", F.to_date("start_time"))
    daily = materialize(ops.length_sketches(named, "user_segment", "day"), "length-sketches")
    found = ops.merged_lengths(daily, "user_segment")
    seconds = F.timestamp_diff("SECOND", F.col("start_time"), F.col("end_time"))
    ranks = named.join(found.withColumnRenamed("sessions", "n"), named["user_segment"].eqNullSafe(found["user_segment"]))
    share = lambda part: F.count_if(part) / F.count(F.lit(1))
    return ranks.groupBy(named["user_segment"]).agg(
        F.max("n").alias("sessions"),
        ((share(seconds < F.col("median_seconds")) <= 0.52) & (share(seconds <= F.col("median_seconds")) >= 0.48)).alias("near_middle"),
    )


def gap_sessions(spark: SparkSession, folder: str) -> DataFrame:
    return ops.gap_sessions(testbed.user_events(spark, folder), 6 * 3600)


def gap_sessions_3m(spark: SparkSession, folder: str) -> DataFrame:
    return ops.gap_sessions(testbed.user_events(spark, folder))


def gap_session_events(spark: SparkSession, folder: str) -> DataFrame:
    return ops.session_starts(testbed.user_events(spark, folder), 6 * 3600).select("event_id", "user_id", "session_no")


def session_timeline(spark: SparkSession, folder: str) -> DataFrame:
    return ops.session_timeline(testbed.user_events(spark, folder)).select(
        "session_id", "event_id", "step", "seconds_since_previous", "minutes_so_far"
    )


def prev_event_carry(spark: SparkSession, folder: str) -> DataFrame:
    return ops.previous_event(testbed.user_events(spark, folder)).select(
        "event_id", "user_id", "event_type", "previous_content", "previous_minutes", "inherited_minutes"
    )


def latest_sessions_top10(spark: SparkSession, folder: str) -> DataFrame:
    return _readable(ops.latest_sessions(ops.session_windows(testbed.user_events(spark, folder)))).drop(
        "window_start", "window_end", "watch_minutes"
    )


def active_sessions(spark: SparkSession, folder: str) -> DataFrame:
    events = testbed.user_events(spark, folder)
    now = events.agg(F.max("timestamp_ts")).scalar()
    return ops.active_sessions(ops.session_summary(events), 6 * 3600, now).select("session_id", "user_id", "end_time", "event_count")


def latest_user_events(spark: SparkSession, folder: str) -> DataFrame:
    return ops.latest_per_user(testbed.user_events(spark, folder), 10).select("user_id", "event_id", "recency")


def user_recent_events(spark: SparkSession, folder: str) -> DataFrame:
    return ops.user_events(testbed.user_events(spark, folder), "user-00007", 20).select(
        "event_id", "event_type", "content_id", F.col("timestamp_ts").alias("ts")
    )


def session_events(spark: SparkSession, folder: str) -> DataFrame:
    return ops.session_events(testbed.user_events(spark, folder), "user-00007-sess-20240105").select(
        "event_id", "event_type", "content_id", F.col("timestamp_ts").alias("ts")
    )


QUERIES = {
    "session_windows_3h": _windows("3 hours"),
    "session_windows_3m": _windows("3 minutes"),
    "session_rollup": session_rollup,
    "session_summary": session_summary,
    "analyze_session": analyze_session,
    "array_to_json": session_table_rows,
    "session_length": session_length,
    "segment_lengths": segment_lengths,
    "gap_sessions": gap_sessions,
    "gap_sessions_3m": gap_sessions_3m,
    "gap_session_events": gap_session_events,
    "session_timeline": session_timeline,
    "prev_event_carry": prev_event_carry,
    "latest_sessions_top10": latest_sessions_top10,
    "active_sessions": active_sessions,
    "latest_user_events": latest_user_events,
    "user_recent_events": user_recent_events,
    "session_events": session_events,
}


def _list(kind: str, name: str) -> str:
    return (
        f"coalesce(string_agg(DISTINCT content_id, ',' ORDER BY content_id) "
        f"FILTER (event_type = '{kind}'), '') AS {name}"
    )


SQL_LISTS = ", ".join(_list(kind, name) for name, kind in ops.LISTS.items())
MEASURES = """CAST(min(ts) AS TIMESTAMP) AS start_time, CAST(max(ts) AS TIMESTAMP) AS end_time,
  count(*) AS event_count,
  CAST(coalesce(sum(watched_minutes), 0) AS BIGINT) AS total_watched_minutes,
  CAST(coalesce(sum(watched_minutes) FILTER (event_type = 'watch'), 0) AS BIGINT) AS watch_minutes"""


def _windows_sql(width: str) -> str:
    return with_(EV) + f"""SELECT session_id, user_id, time_bucket(INTERVAL '{width}', ts) AS window_start,
  time_bucket(INTERVAL '{width}', ts) + INTERVAL '{width}' AS window_end, {MEASURES}, {SQL_LISTS}
FROM ev GROUP BY ALL"""


_SUMMARY_SQL = with_(EV) + f"SELECT session_id, user_id, {MEASURES}, {SQL_LISTS} FROM ev GROUP BY ALL"


def _gap_sql(seconds: int, tail: str) -> str:
    return with_(
        EV,
        "lagged AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM ev)",
        f"""numbered AS (SELECT *, CAST(sum(CASE WHEN before IS NULL OR ts - before >= INTERVAL '{seconds} seconds'
          THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS session_no FROM lagged)""",
    ) + tail


_GAP_AGG = """SELECT user_id, session_no, min(ts) AS start_time, max(ts) AS end_time, count(*) AS event_count,
  CAST(sum(watched_minutes) AS BIGINT) AS total_watched_minutes FROM numbered GROUP BY ALL"""


def _json_list(kind: str, name: str) -> str:
    return (
        f"'[' || coalesce(string_agg(DISTINCT '\"' || content_id || '\"', ',' ORDER BY '\"' || content_id || '\"') "
        f"FILTER (event_type = '{kind}'), '') || ']' AS {name}"
    )


ORACLE = {
    "session_windows_3h": _windows_sql("3 hours"),
    "session_windows_3m": _windows_sql("3 minutes"),
    "session_rollup": _SUMMARY_SQL,
    "session_summary": _SUMMARY_SQL,
    "analyze_session": _SUMMARY_SQL.replace("GROUP BY", "WHERE session_id = 'user-00007-sess-20240105' GROUP BY"),
    "array_to_json": with_(EV) + f"""SELECT session_id, user_id, w AS window_start, w + INTERVAL '3 hours' AS window_end, start_time, end_time, event_count, total_watched_minutes,
  browsed_contents, watched_contents, completed_contents FROM (
  SELECT session_id, user_id, time_bucket(INTERVAL '3 hours', ts) AS w, {MEASURES},
    {', '.join(_json_list(kind, name) for name, kind in ops.LISTS.items())}
  FROM ev GROUP BY ALL)""",
    "segment_lengths": with_(EV, USERS) + """SELECT user_segment, count(*) AS sessions, true AS near_middle
FROM (SELECT DISTINCT session_id, user_id FROM ev) LEFT JOIN users USING (user_id) GROUP BY 1""",
    "session_length": with_(
        EV,
        """spans AS (SELECT session_id, user_id, count(*) AS n,
          CAST(floor(date_diff('microsecond', min(ts), max(ts)) / 1000000.0) AS BIGINT) AS seconds FROM ev GROUP BY ALL)""",
    ) + """SELECT user_id, count(*) AS sessions, round(avg(seconds), 6) AS mean_seconds,
  round(CAST(median(seconds) AS DOUBLE), 6) AS median_seconds, round(avg(n), 6) AS events_per_session
FROM spans GROUP BY user_id""",
    "gap_sessions": _gap_sql(6 * 3600, _GAP_AGG),
    "gap_sessions_3m": _gap_sql(180, _GAP_AGG),
    "gap_session_events": _gap_sql(6 * 3600, "SELECT event_id, user_id, session_no FROM numbered"),
    "session_timeline": with_(EV) + """SELECT session_id, event_id,
  row_number() OVER w AS step,
  CAST(floor(date_diff('microsecond', lag(ts) OVER w, ts) / 1000000.0) AS BIGINT) AS seconds_since_previous,
  CAST(sum(watched_minutes) OVER w AS BIGINT) AS minutes_so_far
FROM ev WINDOW w AS (PARTITION BY session_id ORDER BY ts, event_id)""",
    "prev_event_carry": with_(EV) + """SELECT event_id, user_id, event_type, previous_content, previous_minutes,
  CASE WHEN event_type <> 'rating' THEN watched_minutes
       WHEN previous_content = content_id THEN coalesce(previous_minutes, 0) ELSE 0 END AS inherited_minutes
FROM (SELECT *, lag(content_id) OVER w AS previous_content, lag(watched_minutes) OVER w AS previous_minutes
      FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))""",
    "latest_sessions_top10": f"""SELECT session_id, user_id, start_time, end_time, event_count, total_watched_minutes,
  browsed_contents, watched_contents, completed_contents FROM ({_windows_sql('3 minutes')})
ORDER BY start_time DESC, session_id LIMIT 10""",
    "active_sessions": with_(
        EV, "s AS (SELECT session_id, user_id, max(ts) AS end_time, count(*) AS event_count FROM ev GROUP BY ALL)"
    ) + "SELECT * FROM s WHERE end_time >= (SELECT max(end_time) FROM s) - INTERVAL '6 hours'",
    "latest_user_events": with_(EV) + """SELECT user_id, event_id, CAST(recency AS INTEGER) AS recency FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS recency FROM ev)
WHERE recency <= 10""",
    "user_recent_events": with_(EV) + """SELECT event_id, event_type, content_id, ts FROM ev
WHERE user_id = 'user-00007' ORDER BY ts DESC, event_id DESC LIMIT 20""",
    "session_events": with_(EV) + """SELECT event_id, event_type, content_id, ts FROM ev
WHERE session_id = 'user-00007-sess-20240105' ORDER BY ts, event_id""",
}
