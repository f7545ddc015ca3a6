"""Streaming queries: sessions, gap sessions, raw ingest, attribution, activity.

Event time of a stream is an instant (`timestamp`), as watermarks need; rows
written out carry the UTC wall clock.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from watchlens.functions.times import utc_instant, utc_wall_clock
from watchlens.operators.ingest import accepted, add_event_time, decode_events, parse_messages, use_now_for_bad_time
from watchlens.operators.sessions import session_windows
from watchlens.schemas import (
    INGEST_TRIGGER, SESSION_GAP_SECONDS, SESSION_TRIGGER, SESSION_WATERMARK, SESSION_WINDOW,
)
from watchlens.session import state_on_disk
from watchlens.streaming.metrics import ProgressRecorder
from watchlens.streaming.sinks import batch_log, ingest_writer


def with_watermark(events: DataFrame, delay: str | None, column: str = "timestamp_ts") -> DataFrame:
    """Set the watermark; no delay or `0 seconds` means none."""
    return events.withWatermark(column, delay) if delay and delay != "0 seconds" else events


def with_instants(events: DataFrame, *columns: str) -> DataFrame:
    """Turn wall-clock columns into the instants a watermark needs."""
    return events.withColumns({name: utc_instant(F.col(name)) for name in columns})


def _wall_clocks(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({name: utc_wall_clock(F.col(name)) for name in columns})


def events_from_messages(messages: DataFrame, strict: bool = True) -> DataFrame:
    """Events of a message stream; `strict=False` checks nothing and keeps what decodes."""
    return accepted(parse_messages(messages)) if strict else add_event_time(decode_events(messages))


def session_stream(
    events: DataFrame, window: str = SESSION_WINDOW, watermark: str | None = SESSION_WATERMARK
) -> DataFrame:
    """Session windows of an event stream.

    In `update` mode a window comes out again, complete so far, whenever it
    changes: write it as an upsert. In `append` mode it comes out once, when the
    watermark has passed it.
    """
    windows = session_windows(with_watermark(events, watermark), window)
    return _wall_clocks(windows, "window_start", "window_end", "start_time", "end_time")


def gap_session_stream(
    events: DataFrame, gap_seconds: int = SESSION_GAP_SECONDS, watermark: str = SESSION_WATERMARK
) -> DataFrame:
    """Inactivity sessions per user; `append` mode only.

    Spark merges events exactly one gap apart, where the batch operator starts a
    new session.
    """
    span = F.session_window("timestamp_ts", f"{gap_seconds} seconds")
    sessions = with_watermark(events, watermark).groupBy("user_id", span).agg(
        F.max("timestamp_ts").alias("end_time"),
        F.count(F.lit(1)).alias("event_count"),
        F.coalesce(F.sum("watched_minutes"), F.lit(0)).alias("total_watched_minutes"),
    )
    flat = sessions.select(
        "user_id", F.col("session_window.start").alias("start_time"), "end_time", "event_count", "total_watched_minutes"
    )
    return _wall_clocks(flat, "start_time", "end_time")


def ingest_stream(messages: DataFrame, lenient_time: bool = False) -> DataFrame:
    """Every parsed message, with the reason where it is a reject.

    There is no state and no watermark here, so nothing is late: messages may come in any order
    of their times, be replayed or lag behind, and all are stored. Copies of an event are folded
    where the stored events are read, see `sinks.current_events`. `lenient_time` accepts events
    with an unreadable time as of now.
    """
    parsed = parse_messages(messages)
    return use_now_for_bad_time(parsed) if lenient_time else parsed


def counted(parsed: DataFrame, name: str = "ingest") -> DataFrame:
    """Count consumed, saved and rejected messages of each micro-batch as they pass.

    The counts come with the query's progress under `name`; no second query or
    second read of the source is needed to watch it.
    """
    return parsed.observe(
        name,
        F.count(F.lit(1)).alias("consumed"),
        F.count_if(F.col("reject_reason").isNull()).alias("saved"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("errors"),
    )


def attribution_stream(
    recommendations: DataFrame, events: DataFrame, horizon: str = "7 days",
    watermark: str = SESSION_WATERMARK, unfollowed: bool = False,
) -> DataFrame:
    """Clicks and watches that follow a recommendation of the same content within the horizon.

    Both sides carry a watermark, so the state of either is dropped once no
    partner can come. With `unfollowed`, a recommendation that nothing has followed by then comes out as
    well, once, without event (an outer join).
    """
    recs = recommendations.select("user_id", "content_id", "created_at").withWatermark("created_at", watermark)
    acts = events.where(F.col("event_type").isin("click", "watch", "watch_complete")).select(
        F.col("user_id").alias("actor"), F.col("content_id").alias("acted_on"), "event_type", "event_id", "timestamp_ts"
    ).withWatermark("timestamp_ts", watermark)
    within = (
        (F.col("user_id") == F.col("actor"))
        & (F.col("content_id") == F.col("acted_on"))
        & (F.col("timestamp_ts") >= F.col("created_at"))
        & (F.col("timestamp_ts") <= F.col("created_at") + F.expr(f"INTERVAL {horizon}"))
    )
    joined = recs.join(acts, within, "left" if unfollowed else "inner").select(
        "user_id", "content_id", "created_at", "event_id", "event_type", "timestamp_ts"
    )
    return _wall_clocks(joined, "created_at", "timestamp_ts")


def activity_stream(
    events: DataFrame, key: str, size: str = "3 hours", slide: str = "1 hour", watermark: str = SESSION_WATERMARK
) -> DataFrame:
    """Events per key in sliding windows: the moving sum of a stream."""
    counts = with_watermark(events, watermark).groupBy(key, F.window("timestamp_ts", size, slide)).agg(
        F.count(F.lit(1)).alias("events")
    )
    flat = counts.select(key, F.col("window.start").alias("bucket_start"), F.col("window.end").alias("bucket_end"), "events")
    return _wall_clocks(flat, "bucket_start", "bucket_end")


def start(
    stream: DataFrame, name: str, checkpoint: str, write: Callable[[DataFrame, int], None],
    output_mode: str = "update", every: str | None = None,
) -> StreamingQuery:
    """Start a query with a checkpoint of its own.

    `every` is a processing-time trigger such as `3 seconds`; without it the
    query works through what is there and stops. The number of shuffle
    partitions is fixed by the first run of a checkpoint. State is kept on disk, see `session.state_on_disk`.
    """
    writer = (
        stream.writeStream.queryName(name).outputMode(output_mode)
        .option("checkpointLocation", checkpoint).foreachBatch(write)
    )
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    with state_on_disk(stream.sparkSession):
        return writer.start()


def run(
    stream: DataFrame, name: str, checkpoint: str, write: Callable[[DataFrame, int], None], output_mode: str = "update"
) -> StreamingQuery:
    """Work through everything that is there now; raises when the query fails."""
    query = start(stream, name, checkpoint, write, output_mode)
    query.awaitTermination()
    return query


def finish(query: StreamingQuery) -> None:
    """Wait until a query has ended and, where it writes metrics, until those of its last batch are there."""
    query.awaitTermination()
    recorder = getattr(query, "recorder", None)
    if recorder:
        recorder.wait()


def _start_recorded(
    recorder: ProgressRecorder | None, path: str | None, stream: DataFrame, name: str, checkpoint: str,
    write: Callable[[DataFrame, int], None], output_mode: str, every: str | None,
) -> StreamingQuery:
    if recorder is None:
        return start(stream, name, checkpoint, write, output_mode, every)
    spark = stream.sparkSession

    def write_and_flush(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        recorder.flush(spark, path)

    spark.streams.addListener(recorder)
    query = start(stream, name, checkpoint, write_and_flush, output_mode, every)
    query.recorder = recorder
    return query


def start_sessions(
    messages: DataFrame, checkpoint: str, log: str, window: str = SESSION_WINDOW,
    watermark: str | None = SESSION_WATERMARK, strict: bool = True, every: str | None = SESSION_TRIGGER,
    name: str = "sessions", metrics_path: str | None = None,
) -> StreamingQuery:
    """Track sessions of a message stream into a batch log, see `sinks.current_sessions`.

    With `metrics_path` the query's progress is appended there, the last batch's once `finish` returns.
    """
    stream = session_stream(events_from_messages(messages, strict), window, watermark)
    recorder = ProgressRecorder(name, name, messages.sparkSession, metrics_path) if metrics_path else None
    return _start_recorded(recorder, metrics_path, stream, name, checkpoint, batch_log(log), "update", every)


def start_ingest(
    messages: DataFrame, checkpoint: str, events_path: str, letters_path: str,
    every: str | None = INGEST_TRIGGER, on_failure: Callable[[Exception], None] | None = None,
    name: str = "ingest", lenient_time: bool = False, counts_path: str | None = None,
    failed_path: str | None = None, metrics_path: str | None = None, samples_path: str | None = None,
) -> StreamingQuery:
    """Store the raw events of a message stream and its rejects.

    With `counts_path` every batch logs what it consumed, saved and rejected; with `failed_path`
    the events of a batch that could not be stored are kept as dead letters before the query
    fails; with `metrics_path` the query's progress is appended there after each batch, and the last batch's by the
    time that `finish` returns; with `samples_path` a few accepted events of each batch are kept to look at.
    """
    recorder = ProgressRecorder(name, name, messages.sparkSession, metrics_path) if metrics_path else None

    def failed(error: Exception) -> None:
        if recorder:
            recorder.save_failed(error, name)
        if on_failure:
            on_failure(error)

    write = ingest_writer(events_path, letters_path, failed, counts_path, failed_path, samples_path)
    stream = counted(ingest_stream(messages, lenient_time), name)
    return _start_recorded(recorder, metrics_path, stream, name, checkpoint, write, "append", every)
