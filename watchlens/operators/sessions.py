"""Sessions: by event-time window, by given session id, and by inactivity gap."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from watchlens.functions.jsontext import to_json_text
from watchlens.functions.times import seconds_between
from watchlens.plans.ordered import along_time
from watchlens.schemas import SESSION_GAP_SECONDS, SESSION_WINDOW

# Which event type fills which content list.
LISTS = {"browsed_contents": "click", "watched_contents": "watch", "completed_contents": "watch_complete"}


def _measures() -> list[Column]:
    minutes = F.col("watched_minutes")
    return [
        F.count(F.lit(1)).alias("event_count"),
        F.sum(minutes).alias("total_watched_minutes"),
        F.sum(F.when(F.col("event_type") == "watch", minutes)).alias("watch_minutes"),
        F.min("timestamp_ts").alias("start_time"),
        F.max("timestamp_ts").alias("end_time"),
    ]


def _merged() -> list[Column]:
    return [
        F.sum("event_count").alias("event_count"),
        F.sum("total_watched_minutes").alias("total_watched_minutes"),
        F.sum("watch_minutes").alias("watch_minutes"),
        F.min("start_time").alias("start_time"),
        F.max("end_time").alias("end_time"),
    ]


def _lists(collect: Callable[[Column], Column]) -> list[Column]:
    return [
        collect(F.when(F.col("event_type") == kind, F.col("content_id"))).alias(name) for name, kind in LISTS.items()
    ]


def _by_type_and_content(events: DataFrame, keys: list[str]) -> DataFrame:
    return events.groupBy(*keys, "event_type", "content_id").agg(*_measures())


def _fold(fine: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per (keys, type, content) to one row per keys; each content is there once, so lists are sets."""
    return fine.groupBy(*keys).agg(*_merged(), *_lists(F.collect_list))


def _finish(sessions: DataFrame, null_minutes: bool) -> DataFrame:
    if null_minutes:
        return sessions
    for name in ("total_watched_minutes", "watch_minutes"):
        sessions = sessions.withColumn(name, F.coalesce(name, F.lit(0)))
    return sessions


def session_windows(
    events: DataFrame, window: str = SESSION_WINDOW, null_minutes: bool = False
) -> DataFrame:
    """One row per (session, user, tumbling window).

    Counts, minutes of all event types, minutes of `watch` alone, the distinct
    contents browsed, watched and completed, first and last event time. Events
    without a time are left out. With `null_minutes`, a window whose minutes are
    all missing keeps NULL instead of 0.

    In batch the rows are first combined per content: a session that dominates
    the data is spread over its contents, and the lists are built from one row
    per distinct content. A stream keeps one state row per window instead.
    """
    timed = events.where(F.col("timestamp_ts").isNotNull())
    spans = F.window("timestamp_ts", window)
    if events.isStreaming:
        grouped = timed.groupBy("session_id", "user_id", spans).agg(*_measures(), *_lists(F.collect_set))
        windows = grouped.withColumns(
            {"window_start": F.col("window.start"), "window_end": F.col("window.end")}
        ).drop("window")
    else:
        keyed = timed.select(
            "session_id", "user_id", "event_type", "content_id", "watched_minutes", "timestamp_ts",
            spans.alias("w"),
        ).select(
            "*", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end")
        ).drop("w")
        keys = ["session_id", "user_id", "window_start", "window_end"]
        windows = _fold(_by_type_and_content(keyed, keys), keys)
    ordered = [
        "session_id", "user_id", "window_start", "window_end", "start_time", "end_time",
        "event_count", "total_watched_minutes", "watch_minutes", *LISTS,
    ]
    return _finish(windows, null_minutes).select(*ordered)


def session_rollup(windows: DataFrame) -> DataFrame:
    """Session windows merged to one row per (session, user). All measures merge exactly.

    List items are combined per content before a session is brought together,
    so a session of very many windows does not land in one task as it is.
    """
    def items(name: str, kind: str) -> Column:
        return F.transform(name, lambda content: F.struct(F.lit(kind).alias("event_type"), content.alias("content_id")))

    # The row of the measures carries no content and so enters no list.
    measures = F.array(
        F.struct(F.lit(None).cast("string").alias("event_type"), F.lit(None).cast("string").alias("content_id"))
    )
    exploded = windows.select(
        "session_id", "user_id", "start_time", "end_time", "event_count", "total_watched_minutes", "watch_minutes",
        F.explode(F.concat(measures, *[items(name, kind) for name, kind in LISTS.items()])).alias("item"),
    ).select("*", "item.*").drop("item")
    measured = F.col("event_type").isNull()
    fine = exploded.groupBy("session_id", "user_id", "event_type", "content_id").agg(
        F.sum(F.when(measured, F.col("event_count"))).alias("event_count"),
        F.sum(F.when(measured, F.col("total_watched_minutes"))).alias("total_watched_minutes"),
        F.sum(F.when(measured, F.col("watch_minutes"))).alias("watch_minutes"),
        F.min("start_time").alias("start_time"),
        F.max("end_time").alias("end_time"),
    )
    return _fold(fine, ["session_id", "user_id"])


def session_summary(events: DataFrame) -> DataFrame:
    """One row per (session, user) straight from events."""
    timed = events.where(F.col("timestamp_ts").isNotNull())
    keys = ["session_id", "user_id"]
    return _finish(_fold(_by_type_and_content(timed, keys), keys), null_minutes=False)


def analyze_session(events: DataFrame, session_id: str) -> DataFrame:
    """Summary of one session; the filter reaches the scan."""
    return session_summary(events.where(F.col("session_id") == session_id))


def as_table_row(sessions: DataFrame) -> DataFrame:
    """Sessions with their lists as JSON text, as a relational table stores them; windows keep their key."""
    window = [name for name in ("window_start", "window_end") if name in sessions.columns]
    return sessions.select(
        "session_id", "user_id", *window, "start_time", "end_time", "event_count", "total_watched_minutes",
        *[to_json_text(F.array_sort(name)).alias(name) for name in LISTS],
    )


def session_lengths(sessions: DataFrame) -> DataFrame:
    """Per user: sessions, mean and median length in whole seconds, events per session."""
    seconds = seconds_between(F.col("start_time"), F.col("end_time"))
    return (
        sessions.select("user_id", "event_count", seconds.alias("seconds"))
        .groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("sessions"),
            F.avg("seconds").alias("mean_seconds"),
            F.percentile("seconds", 0.5).alias("median_seconds"),
            F.avg("event_count").alias("events_per_session"),
        )
    )


def length_sketches(sessions: DataFrame, *keys: str) -> DataFrame:
    """Number of sessions and a quantile sketch of their lengths in whole seconds, per `keys` or in all.

    Sketches merge (`merged_lengths`): those of days to months, of users' segments to all. At their default size a quantile's rank is within 1.7 %
    of the one asked for, in 99 of 100 sketches.
    """
    seconds = seconds_between(F.col("start_time"), F.col("end_time")).cast("bigint")
    rows = sessions.select(*keys, seconds.alias("seconds"))
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("sessions"), F.kll_sketch_agg_bigint("seconds").alias("lengths"))


def merged_lengths(sketches: DataFrame, *keys: str) -> DataFrame:
    """Sessions and median length of coarser groups, from sketches alone."""
    return sketches.groupBy(*keys).agg(
        F.sum("sessions").alias("sessions"), F.kll_merge_agg_bigint("lengths").alias("lengths")
    ).select(*keys, "sessions", F.kll_sketch_get_quantile_bigint("lengths", F.lit(0.5)).alias("median_seconds"))


def session_starts(events: DataFrame, gap_seconds: int = SESSION_GAP_SECONDS) -> DataFrame:
    """Events numbered into sessions per user: a new one starts when the pause reaches the gap.

    Adds `session_no`, from 1; NULL for events without user or time.
    """
    return along_time(events, ["user_id"], ["timestamp_ts", "event_id"], gap=("session_no", gap_seconds * 1000000))


def gap_sessions(events: DataFrame, gap_seconds: int = SESSION_GAP_SECONDS) -> DataFrame:
    """One row per gap session of a user; events without user or time are left out.

    Numbered events of a user come out of few tasks, so nearly all of them combine before the second shuffle.
    """
    slim = events.select("user_id", "event_id", "timestamp_ts", "watched_minutes")
    numbered = session_starts(slim.where(F.col("user_id").isNotNull() & F.col("timestamp_ts").isNotNull()), gap_seconds)
    return numbered.groupBy("user_id", "session_no").agg(
        F.min("timestamp_ts").alias("start_time"),
        F.max("timestamp_ts").alias("end_time"),
        F.count(F.lit(1)).alias("event_count"),
        F.coalesce(F.sum("watched_minutes"), F.lit(0)).alias("total_watched_minutes"),
    )


def session_timeline(events: DataFrame) -> DataFrame:
    """Events of each session with step number, seconds since the step before and minutes so far."""
    steps = along_time(
        events,
        ["session_id"],
        ["timestamp_ts", "event_id"],
        previous={"previous_ts": F.col("timestamp_ts")},
        running={"step": F.lit(1), "minutes_so_far": F.coalesce("watched_minutes", F.lit(0))},
    )
    return steps.withColumn(
        "seconds_since_previous", seconds_between(F.col("previous_ts"), F.col("timestamp_ts"))
    ).drop("previous_ts")


def previous_event(events: DataFrame) -> DataFrame:
    """Events with the user's previous content and minutes.

    `inherited_minutes`: a rating takes over the previous minutes when it rates
    the same content, and 0 otherwise; other events keep their own.
    """
    carried = along_time(
        events,
        ["user_id"],
        ["timestamp_ts", "event_id"],
        previous={"previous_content": F.col("content_id"), "previous_minutes": F.col("watched_minutes")},
    )
    same = F.coalesce(F.col("previous_content") == F.col("content_id"), F.lit(False))
    inherited = F.when(F.col("event_type") != "rating", F.col("watched_minutes")).otherwise(
        F.when(same, F.coalesce("previous_minutes", F.lit(0))).otherwise(0)
    )
    return carried.withColumn("inherited_minutes", inherited)


def latest_per_user(events: DataFrame, limit: int = 10) -> DataFrame:
    """The latest `limit` events of every user, ranked from 1.

    The rank filter also runs before the shuffle, so a user ships at most
    `limit` rows per task.
    """
    newest = Window.partitionBy("user_id").orderBy(F.desc("timestamp_ts"), F.desc("event_id"))
    return events.withColumn("recency", F.row_number().over(newest)).where(F.col("recency") <= limit)


def user_events(events: DataFrame, user_id: str, limit: int) -> DataFrame:
    """The latest events of one user."""
    mine = events.where(F.col("user_id") == user_id)
    return mine.orderBy(F.desc("timestamp_ts"), F.desc("event_id")).limit(limit)


def session_events(events: DataFrame, session_id: str) -> DataFrame:
    """The events of one session in order."""
    return events.where(F.col("session_id") == session_id).orderBy("timestamp_ts", "event_id")


def latest_sessions(sessions: DataFrame, limit: int = 10) -> DataFrame:
    """The sessions that started last."""
    return sessions.orderBy(F.desc("start_time"), "session_id").limit(limit)


def active_sessions(
    sessions: DataFrame, gap_seconds: int = SESSION_GAP_SECONDS, now: Column | None = None
) -> DataFrame:
    """Sessions whose last event is no older than the gap, seen from `now` or from the latest event."""
    moment = sessions.agg(F.max("end_time")).scalar() if now is None else now
    return sessions.where(F.col("end_time") >= moment - F.make_dt_interval(secs=F.lit(gap_seconds)))
