"""Streaming queries, run over the whole tables and read back from their sinks."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.ingest import ORACLE as INGEST_SQL
from catalog.recommend import HORIZON_DAYS
from catalog.sessions import _GAP_AGG, _gap_sql, _readable, _windows_sql
from catalog.sqltext import EV, RECS, with_
from watchlens.operators.sessions import session_windows
from watchlens.operators.stats import hash_sample
from watchlens.operators.tables import fill_defaults
from watchlens.schemas import TABLES
from watchlens.session import shared_folder
from watchlens.sources import messages, testbed
from watchlens.streaming import queries, sinks

#: Batches that a staged table comes in, and rows of one of its files.
STAGED_BATCHES, STAGED_ROWS = 4, 100_000
# Longer than the data: files of a staged table come in any order, none is late.
LONG_WATERMARK = "60 days"


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    raw = messages.file_stream(spark, f"{folder}/events.parquet", testbed.EVENTS_SCHEMA)
    return queries.with_instants(testbed.as_user_events(raw), "timestamp_ts")


def _run_to_log(spark: SparkSession, stream: DataFrame, name: str, mode: str) -> DataFrame:
    folder = shared_folder(spark, name)
    queries.run(stream, name, f"{folder}/checkpoint", sinks.batch_log(f"{folder}/log"), mode)
    return spark.read.parquet(f"{folder}/log")


def _files_a_batch(events: DataFrame) -> int:
    return max(1, math.ceil(events.count() / STAGED_BATCHES / STAGED_ROWS))


def _staged(spark: SparkSession, folder: str, work: str) -> DataFrame:
    """The events as several files, in ranges of their time, that come a part of the files a batch."""
    events = testbed.table(spark, folder, "events")
    files = _files_a_batch(events)
    events.repartitionByRange(STAGED_BATCHES * files, "ts").write.parquet(f"{work}/staged")
    return messages.file_stream(spark, f"{work}/staged", testbed.EVENTS_SCHEMA, max_files_per_trigger=files)


def stream_sessions_update(spark: SparkSession, folder: str) -> DataFrame:
    """Events come in several batches; every change of a window replaces its row."""
    work = shared_folder(spark, "sessions-update")
    raw = _staged(spark, folder, work)
    stream = queries.with_instants(testbed.as_user_events(raw), "timestamp_ts")
    windows = queries.session_stream(stream, "3 hours", LONG_WATERMARK)
    queries.run(windows, "sessions-update", f"{work}/checkpoint", sinks.batch_log(f"{work}/log"), "update")
    return _readable(sinks.current_sessions(spark, f"{work}/log"))


def stream_sessions_append(spark: SparkSession, folder: str) -> DataFrame:
    """Each window once, when the watermark has passed it."""
    windows = queries.session_stream(_event_stream(spark, folder))
    return _readable(_run_to_log(spark, windows, "sessions-append", "append").drop("batch_id"))


def stream_gap_sessions(spark: SparkSession, folder: str) -> DataFrame:
    sessions = queries.gap_session_stream(_event_stream(spark, folder), 6 * 3600)
    return _run_to_log(spark, sessions, "gap-sessions", "append").drop("batch_id")


def stream_sliding_activity(spark: SparkSession, folder: str) -> DataFrame:
    counts = queries.activity_stream(_event_stream(spark, folder), "event_type")
    return _run_to_log(spark, counts, "activity", "append").drop("batch_id")


def _ingest(spark: SparkSession, folder: str, name: str) -> str:
    work = shared_folder(spark, name)
    raw = messages.file_stream(spark, f"{folder}/events.parquet", testbed.EVENTS_SCHEMA)
    _store(testbed.as_messages(raw), name, work)
    return work


def _store(received: DataFrame, name: str, work: str) -> None:
    writer = sinks.ingest_writer(f"{work}/events", f"{work}/letters", counts_path=f"{work}/counts")
    queries.run(queries.counted(queries.ingest_stream(received)), name, f"{work}/checkpoint", writer, "append")


def stream_dedupe_ingest(spark: SparkSession, folder: str) -> DataFrame:
    return sinks.current_events(spark, f"{_ingest(spark, folder, 'ingest')}/events")


def stream_ingest_out_of_order(spark: SparkSession, folder: str) -> DataFrame:
    """Messages that come the latest first, a part of the time a batch: nothing may be lost."""
    work = shared_folder(spark, "out-of-order")
    events = testbed.table(spark, folder, "events")
    span = events.agg(F.min("ts").alias("first"), F.max("ts").alias("last")).first()
    files = _files_a_batch(events)
    edges = [span.first + (span.last - span.first) * k / STAGED_BATCHES for k in range(STAGED_BATCHES)]
    for k in reversed(range(STAGED_BATCHES)):
        part = events.where(F.col("ts") >= F.lit(edges[k]).cast("timestamp_ntz"))
        if k + 1 < STAGED_BATCHES:
            part = part.where(F.col("ts") < F.lit(edges[k + 1]).cast("timestamp_ntz"))
        # As many files a part as a batch takes, however many tasks read the events.
        part.repartition(files).write.mode("append").parquet(f"{work}/staged")
    raw = messages.file_stream(spark, f"{work}/staged", testbed.EVENTS_SCHEMA, max_files_per_trigger=files)
    _store(testbed.as_messages(raw), "out-of-order", work)
    return sinks.current_events(spark, f"{work}/events")


def stream_dead_letters(spark: SparkSession, folder: str) -> DataFrame:
    work = _ingest(spark, folder, "letters")
    return spark.read.parquet(f"{work}/letters").drop("batch_id", "timestamp")


def stream_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """What the ingest query counted in all its batches, and the copies among the stored events."""
    work = _ingest(spark, folder, "metrics")
    names = ["consumed", "saved", "errors"]
    totals = spark.read.parquet(f"{work}/counts").agg(*[F.sum(name).alias(name) for name in names])
    copies = spark.read.parquet(f"{work}/events").groupBy("event_id").count()
    copies = copies.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("metric_value"))
    rows = totals.unpivot([], names, "metric_name", "metric_value")
    return rows.unionByName(copies.select(F.lit("duplicates").alias("metric_name"), "metric_value"))


def stream_sessions_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """Sessions out of a snapshot made in two steps; the log of the first is gone by the second."""
    work = shared_folder(spark, "snapshot")
    raw = _staged(spark, folder, work)
    stream = queries.with_instants(testbed.as_user_events(raw), "timestamp_ts")
    windows = queries.session_stream(stream, "3 hours", LONG_WATERMARK)

    def write(df: DataFrame, batch_id: int) -> None:
        sinks.write_batch(df, f"{work}/{'early' if batch_id < STAGED_BATCHES // 2 else 'late'}", batch_id)

    queries.run(windows, "snapshot", f"{work}/checkpoint", write, "update")
    for log in ("early", "late"):
        sinks.write_snapshot(spark, f"{work}/{log}", sinks.SESSION_KEY, f"{work}/snapshot")
    return _readable(sinks.current_sessions(spark, f"{work}/none", f"{work}/snapshot"))


def user_sessions_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Session windows as the engine's own table stores them, at its key."""
    windows = session_windows(testbed.user_events(spark, folder), "3 hours")
    stamp = F.expr("TIMESTAMP_NTZ'2024-02-01 00:00:00'")
    return _readable(fill_defaults(windows, TABLES["user_sessions"], stamp))


def _attributed(spark: SparkSession, folder: str, name: str, unfollowed: bool) -> DataFrame:
    work = shared_folder(spark, name)
    testbed.recommendations(spark, folder).write.parquet(f"{work}/recs")
    recs = messages.file_stream(spark, f"{work}/recs", spark.read.parquet(f"{work}/recs").schema)
    joined = queries.attribution_stream(
        queries.with_instants(recs, "created_at"), _event_stream(spark, folder), f"{HORIZON_DAYS} days", unfollowed=unfollowed
    )
    queries.run(joined, name, f"{work}/checkpoint", sinks.batch_log(f"{work}/log"), "append")
    return spark.read.parquet(f"{work}/log").select("user_id", "content_id", "created_at", "event_id", "event_type")


def stream_attribution(spark: SparkSession, folder: str) -> DataFrame:
    return _attributed(spark, folder, "attribution", False)


def stream_unfollowed(spark: SparkSession, folder: str) -> DataFrame:
    """Recommendations that nothing followed, of those whose time is over."""
    rows = _attributed(spark, folder, "unfollowed", True)
    return rows.where(F.col("event_id").isNull()).select("user_id", "content_id", "created_at")


def stream_samples(spark: SparkSession, folder: str) -> DataFrame:
    """The sample of a stream in several batches, out of the batches' own samples."""
    work = shared_folder(spark, "samples")
    raw = _staged(spark, folder, work)
    writer = sinks.ingest_writer(f"{work}/events", f"{work}/letters", samples_path=f"{work}/samples")
    queries.run(queries.ingest_stream(testbed.as_messages(raw)), "samples", f"{work}/checkpoint", writer, "append")
    return hash_sample(spark.read.parquet(f"{work}/samples").select("event_id").distinct(), sinks.SAMPLE_ROWS, "event_id")


QUERIES = {
    "stream_sessions_update": stream_sessions_update,
    "stream_sessions_append": stream_sessions_append,
    "stream_gap_sessions": stream_gap_sessions,
    "stream_sliding_activity": stream_sliding_activity,
    "stream_dedupe_ingest": stream_dedupe_ingest,
    "stream_ingest_out_of_order": stream_ingest_out_of_order,
    "stream_dead_letters": stream_dead_letters,
    "stream_sessions_snapshot": stream_sessions_snapshot,
    "user_sessions_rows": user_sessions_rows,
    "stream_metrics": stream_metrics,
    "stream_attribution": stream_attribution,
    "stream_unfollowed": stream_unfollowed,
    "stream_samples": stream_samples,
}

_PASSED = "(SELECT max(ts) - INTERVAL '10 minutes' FROM events)"
_LETTERS = INGEST_SQL["dead_letters"].replace("ts AS timestamp, ", "")
_FIRST = INGEST_SQL["dedupe_events"].rsplit("SELECT", 1)[0]

ORACLE = {
    "stream_sessions_update": _windows_sql("3 hours"),
    "stream_sessions_append": f"SELECT * FROM ({_windows_sql('3 minutes')}) WHERE window_end <= {_PASSED}",
    "stream_gap_sessions": f"""SELECT user_id, start_time, end_time, event_count, total_watched_minutes
FROM ({_gap_sql(6 * 3600, _GAP_AGG)}) WHERE end_time + INTERVAL '6 hours' <= {_PASSED}""",
    "stream_sliding_activity": with_(EV) + f"""SELECT event_type, bucket_start, bucket_start + INTERVAL '3 hours' AS bucket_end,
  count(*) AS events FROM (SELECT event_type, date_trunc('hour', ts) - to_hours(CAST(back AS INTEGER)) AS bucket_start
    FROM ev, (SELECT unnest([0, 1, 2]) AS back))
WHERE bucket_start + INTERVAL '3 hours' <= {_PASSED} GROUP BY ALL""",
    "stream_dedupe_ingest": INGEST_SQL["ingest_projection"],
    "stream_dead_letters": _LETTERS,
    "stream_ingest_out_of_order": INGEST_SQL["ingest_projection"],
    "stream_sessions_snapshot": _windows_sql("3 hours"),
    "user_sessions_rows": f"""SELECT * EXCLUDE (watch_minutes), TIMESTAMP '2024-02-01' AS created_at, TIMESTAMP '2024-02-01' AS updated_at
FROM ({_windows_sql("3 hours")})""",
    "stream_metrics": _FIRST + """SELECT 'consumed' AS metric_name, count(*) AS metric_value FROM judged
UNION ALL SELECT 'saved', count(*) FROM judged WHERE reject_reason IS NULL
UNION ALL SELECT 'errors', count(*) FROM judged WHERE reject_reason IS NOT NULL
UNION ALL SELECT 'duplicates', (SELECT count(*) FROM judged WHERE reject_reason IS NULL) - (SELECT count(*) FROM first_good)""",
    "stream_unfollowed": with_(EV, RECS) + f"""SELECT user_id, content_id, created_at FROM recs
WHERE created_at + INTERVAL '{HORIZON_DAYS} days' < least((SELECT max(created_at) FROM recs), (SELECT max(ts) FROM ev)) - INTERVAL '10 minutes'
AND NOT EXISTS (SELECT 1 FROM ev WHERE ev.user_id = recs.user_id AND ev.content_id = recs.content_id
  AND event_type IN ('click', 'watch', 'watch_complete') AND ts BETWEEN created_at AND created_at + INTERVAL '{HORIZON_DAYS} days')""",
    "stream_samples": _FIRST + """SELECT event_id, CAST(place AS INTEGER) AS place FROM (
  SELECT event_id, row_number() OVER (ORDER BY sha256(event_id)) AS place FROM (SELECT DISTINCT event_id FROM first_good)) WHERE place <= 5""",
    "stream_attribution": with_(EV, RECS) + f"""SELECT recs.user_id, recs.content_id, created_at, event_id, event_type FROM recs JOIN ev
ON ev.user_id = recs.user_id AND ev.content_id = recs.content_id AND ts BETWEEN created_at AND created_at + INTERVAL '{HORIZON_DAYS} days'
WHERE event_type IN ('click', 'watch', 'watch_complete')""",
}
