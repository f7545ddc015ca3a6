import datetime
import hashlib
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from tests.test_ingest import CASES, SAMPLE, as_messages
from watchlens.operators import stored
from watchlens.operators.ingest import accepted, parse_messages, stored_event
from watchlens.operators.sessions import active_sessions, session_windows
from watchlens.operators.stats import heat_map
from watchlens.schemas import TABLES
from watchlens.session import ROCKSDB_PROVIDER, STATE_CONF, state_on_disk
from watchlens.sources import messages
from watchlens.streaming import metrics, queries, sinks

EVENT = (
    "event_id string, user_id string, session_id string, event_type string, content_id string, "
    "watched_minutes int, timestamp_ts timestamp_ntz"
)
# Batches of (session, time): the fourth and fifth bring late events.
LATE = [
    [("s1", "00:00:10"), ("s1", "00:01:10")],
    [("s1", "00:02:00"), ("s1", "00:03:30")],
    [("s2", "01:00:00")],
    [("s1", "00:02:30")],
    [("s1", "00:02:40")],
    [("s2", "01:00:20")],
]


class Folder:
    """Files that arrive one after the other."""

    def __init__(self, spark, path):
        self.spark, self.path, self.files = spark, path, 0
        path.mkdir()

    def add(self, df):
        out = self.path.parent / f"{self.path.name}-part-{self.files}"
        df.coalesce(1).write.parquet(str(out))
        (part,) = out.glob("part-*.parquet")
        target = self.path / f"{self.files:03d}.parquet"
        os.link(part, target)
        os.utime(target, (1_700_000_000 + self.files * 10,) * 2)
        self.files += 1


def event_rows(batch, start):
    return [
        (f"e{start + i}", "u", session, "watch", f"c{start + i}", 5, datetime.datetime.fromisoformat(f"2026-01-01T{ts}"))
        for i, (session, ts) in enumerate(batch)
    ]


@pytest.fixture
def late_folder(spark, tmp_path):
    folder = Folder(spark, tmp_path / "events")
    n = 0
    for batch in LATE:
        folder.add(spark.createDataFrame(event_rows(batch, n), EVENT))
        n += len(batch)
    return folder


def stream_of(spark, folder):
    raw = messages.file_stream(spark, str(folder.path), EVENT, max_files_per_trigger=1)
    return queries.with_instants(raw, "timestamp_ts")


def emitted(spark, log):
    rows = spark.read.parquet(log).collect()
    return sorted((r.batch_id, r.session_id, f"{r.window_start:%H:%M}", r.event_count) for r in rows)


def test_update_mode_counts_late_events_until_the_watermark_of_the_batch_before(spark, tmp_path, late_folder):
    query = queries.run(
        queries.session_stream(stream_of(spark, late_folder)), "late", str(tmp_path / "ck"),
        sinks.batch_log(str(tmp_path / "log")), "update",
    )
    assert emitted(spark, str(tmp_path / "log")) == [
        (0, "s1", "00:00", 2), (1, "s1", "00:00", 3), (1, "s1", "00:03", 1), (2, "s2", "01:00", 1),
        (3, "s1", "00:00", 4), (5, "s2", "01:00", 2),
    ]
    dropped = sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
    assert dropped == 1
    current = sinks.current_sessions(spark, str(tmp_path / "log")).collect()
    assert sorted((r.session_id, r.event_count) for r in current) == [("s1", 1), ("s1", 4), ("s2", 2)]


def test_append_mode_emits_each_window_once(spark, tmp_path, late_folder):
    queries.run(
        queries.session_stream(stream_of(spark, late_folder)), "late-append", str(tmp_path / "ck"),
        sinks.batch_log(str(tmp_path / "log")), "append",
    )
    assert [row[1:] for row in emitted(spark, str(tmp_path / "log"))] == [("s1", "00:00", 4), ("s1", "00:03", 1)]


def test_without_watermark_nothing_is_late(spark, tmp_path, late_folder):
    stream = queries.session_stream(stream_of(spark, late_folder), watermark="0 seconds")
    queries.run(stream, "no-watermark", str(tmp_path / "ck"), sinks.batch_log(str(tmp_path / "log")), "update")
    current = sinks.current_sessions(spark, str(tmp_path / "log")).collect()
    assert sorted((r.session_id, r.event_count) for r in current) == [("s1", 1), ("s1", 5), ("s2", 2)]


def test_a_failed_batch_runs_again_after_restart_and_nothing_is_lost(spark, tmp_path, late_folder):
    log, checkpoint = str(tmp_path / "log"), str(tmp_path / "ck")

    def failing(df, batch_id):
        if batch_id == 2:
            # Part of the output may already be there when the batch fails.
            sinks.write_batch(df.limit(0), log, batch_id)
            raise RuntimeError("sink down")
        sinks.write_batch(df, log, batch_id)

    stream = queries.session_stream(stream_of(spark, late_folder), watermark=queries.SESSION_WATERMARK)
    with pytest.raises(Exception, match="sink down"):
        queries.run(stream, "restart", checkpoint, failing, "update")
    stream = queries.session_stream(stream_of(spark, late_folder))
    queries.run(stream, "restart", checkpoint, sinks.batch_log(log), "update")
    current = sinks.current_sessions(spark, log).collect()
    assert sorted((r.session_id, r.event_count) for r in current) == [("s1", 1), ("s1", 4), ("s2", 2)]


def test_new_files_are_picked_up_where_the_checkpoint_stopped(spark, tmp_path):
    folder = Folder(spark, tmp_path / "events")
    log, checkpoint = str(tmp_path / "log"), str(tmp_path / "ck")
    for n, batch in enumerate([[("s1", "00:00:10")], [("s1", "00:00:20")]]):
        folder.add(spark.createDataFrame(event_rows(batch, n), EVENT))
        queries.run(queries.session_stream(stream_of(spark, folder)), "resume", checkpoint, sinks.batch_log(log), "update")
        (row,) = sinks.current_sessions(spark, log).collect()
        assert row.event_count == n + 1


def test_snapshot_of_the_log_gives_the_same_sessions(spark, tmp_path, late_folder):
    log, snapshot = str(tmp_path / "log"), str(tmp_path / "snapshot")
    stream = queries.session_stream(stream_of(spark, late_folder))
    queries.run(stream, "snapshot", str(tmp_path / "ck"), sinks.batch_log(log), "update")
    whole = sorted(map(str, sinks.current_sessions(spark, log).collect()))
    early = str(tmp_path / "early")
    for batch_id in range(2):
        df = spark.read.parquet(log).where(F.col("batch_id") == batch_id).drop("batch_id")
        sinks.write_batch(df, early, batch_id)
    sinks.write_snapshot(spark, early, sinks.SESSION_KEY, snapshot)
    columns = sinks.current_sessions(spark, log).columns
    read = lambda path: sorted(map(str, sinks.current_sessions(spark, path, snapshot).select(columns).collect()))
    assert read(log) == whole
    # The folded batches are gone now; folding the rest must not lose them.
    late = str(tmp_path / "late")
    for batch_id in range(2, 6):
        df = spark.read.parquet(log).where(F.col("batch_id") == batch_id).drop("batch_id")
        sinks.write_batch(df, late, batch_id)
    sinks.write_snapshot(spark, late, sinks.SESSION_KEY, snapshot)
    assert read(late) == whole and read(str(tmp_path / "no log at all")) == whole
    sinks.write_snapshot(spark, late, sinks.SESSION_KEY, snapshot)
    assert read(late) == whole


def test_stream_of_many_batches_equals_batch(spark, tmp_path):
    folder = Folder(spark, tmp_path / "events")
    from tests.test_sessions import random_rows

    rows = sorted(random_rows(9), key=lambda r: r[6])
    frames = []
    for i in range(0, len(rows), 100):
        part = [(*r[:6], datetime.datetime.fromisoformat(f"2026-01-01T{r[6]}")) for r in rows[i : i + 100]]
        frames += part
        folder.add(spark.createDataFrame(part, EVENT))
    log = str(tmp_path / "log")
    queries.run(queries.session_stream(stream_of(spark, folder), "1 hour"), "equal", str(tmp_path / "ck"), sinks.batch_log(log), "update")

    def shape(df):
        lists = ("browsed_contents", "watched_contents", "completed_contents")
        plain = [c for c in sorted(df.columns) if c not in lists]
        return sorted((*[str(r[c]) for c in plain], *[tuple(sorted(r[c])) for c in lists]) for r in df.collect())

    batch = session_windows(spark.createDataFrame(frames, EVENT), "1 hour")
    assert shape(sinks.current_sessions(spark, log)) == shape(batch)


def test_ingest_stream_keeps_every_event_and_every_reject(spark, tmp_path):
    folder = Folder(spark, tmp_path / "messages")
    values = [value for value, _ in CASES]
    distinct = [json.dumps({**json.loads(v), "event_id": f"e{i}"}) if r is None else v for i, (v, r) in enumerate(CASES)]
    folder.add(as_messages(spark, distinct))
    # The same events again, as new messages.
    folder.add(as_messages(spark, distinct).withColumn("offset", F.col("offset") + 1000))
    raw = messages.file_stream(spark, str(folder.path), max_files_per_trigger=1)
    paths = {name: str(tmp_path / name) for name in ("ck", "ev", "dl", "counts", "metrics")}
    query = queries.start_ingest(
        raw, paths["ck"], paths["ev"], paths["dl"], every=None, name="twice",
        counts_path=paths["counts"], metrics_path=paths["metrics"], samples_path=str(tmp_path / "samples"),
    )
    queries.finish(query)
    good, bad = sum(reason is None for _, reason in CASES), sum(reason is not None for _, reason in CASES)
    stored = spark.read.parquet(paths["ev"])
    assert stored.count() == 2 * good
    once = sinks.current_events(spark, paths["ev"])
    assert once.count() == once.select("event_id").distinct().count() == good
    assert "offset" not in once.columns
    assert spark.read.parquet(paths["dl"]).count() == 2 * bad
    totals = spark.read.parquet(paths["counts"]).agg(F.sum("consumed"), F.sum("saved"), F.sum("errors")).first()
    assert tuple(totals) == (2 * len(values), 2 * good, 2 * bad)
    rows = spark.read.parquet(paths["metrics"])
    assert [f.name for f in rows.schema] == TABLES["system_metrics"].columns.fieldNames()
    last = {r.metric_name: r.metric_value for r in rows.orderBy("timestamp", "metric_value").collect()}
    top = {name: max(r.metric_value for r in rows.collect() if r.metric_name == name) for name in last}
    assert (top[metrics.CONSUMED], top[metrics.SAVED], top[metrics.PARSE_ERRORS]) == (2 * len(values), 2 * good, 2 * bad)
    assert last[metrics.RUNNING] == 0 and {r.labels["query"] for r in rows.collect()} == {"twice"}
    samples = spark.read.parquet(str(tmp_path / "samples"))
    ids = sorted((r.event_id for r in once.collect()), key=lambda i: hashlib.sha256(i.encode()).hexdigest())[: sinks.SAMPLE_ROWS]
    assert sorted((r.batch_id, r.event_id) for r in samples.collect()) == sorted((b, i) for b in (0, 1) for i in ids)


def test_metrics_of_one_query_leave_out_others(spark, tmp_path):
    folder = Folder(spark, tmp_path / "messages")
    for k in range(3):
        folder.add(as_messages(spark, [json.dumps({**SAMPLE, "event_id": f"e{k}-{i}"}) for i in range(10)]))
    raw = messages.file_stream(spark, str(folder.path), max_files_per_trigger=1)
    args = lambda name: [str(tmp_path / f"{name}-{part}") for part in ("ck", "ev", "dl")]
    other = queries.start_ingest(raw, *args("other"), every=None, name="other")
    first = queries.start_ingest(raw, *args("first"), every=None, name="first", metrics_path=str(tmp_path / "first-m"))
    second = queries.start_sessions(
        raw, str(tmp_path / "s-ck"), str(tmp_path / "s-log"), every=None, name="second", metrics_path=str(tmp_path / "second-m")
    )
    for query in (other, first, second):
        queries.finish(query)
    for name in ("first", "second"):
        rows = spark.read.parquet(str(tmp_path / f"{name}-m")).collect()
        assert {r.labels["query"] for r in rows} == {name}
        assert max(r.metric_value for r in rows if r.metric_name == metrics.CONSUMED) >= 30
    assert max(r.metric_value for r in spark.read.parquet(str(tmp_path / "first-m")).collect() if r.metric_name == metrics.SAVED) == 30


def test_new_events_are_added_once_to_a_stored_table(spark, tmp_path):
    folder, path = Folder(spark, tmp_path / "messages"), str(tmp_path / "table")
    for ids in (["a", "b", "a"], ["b", "c"], ["c", "a"]):
        folder.add(as_messages(spark, [json.dumps({**SAMPLE, "event_id": i}) for i in ids]))
    raw = messages.file_stream(spark, str(folder.path), max_files_per_trigger=1)
    parsed = parse_messages(spark.read.schema(raw.schema).parquet(str(folder.path)).limit(0))
    stored.create(stored_event(accepted(parsed), sinks.ARRIVAL), path, ["event_id"], 4)
    queries.run(queries.ingest_stream(raw), "new-events", str(tmp_path / "ck"), sinks.new_events_writer(path), "append")
    assert sorted(r.event_id for r in stored.read(spark, path).collect()) == ["a", "b", "c"]


def test_unfollowed_recommendations_come_out_when_their_time_is_over(spark, tmp_path):
    at = lambda text: datetime.datetime.fromisoformat(f"2026-01-{text}")
    recs = spark.createDataFrame(
        [("u", "c1", at("01 10:00")), ("u", "c2", at("01 10:00")), ("v", "c1", at("01 11:00")), ("u", "c9", at("20 10:00"))],
        "user_id string, content_id string, created_at timestamp",
    )
    events = spark.createDataFrame(
        [("e1", "u", "c1", "click", at("02 10:00")), ("e2", "u", "c1", "watch", at("02 11:00")), ("e3", "v", "c1", "click", at("12 10:00")),
         ("e4", "w", "c1", "click", at("20 10:00"))],
        "event_id string, user_id string, content_id string, event_type string, timestamp_ts timestamp",
    )
    streams = []
    for name, df in (("recs", recs), ("events", events)):
        df.coalesce(1).write.parquet(str(tmp_path / name))
        streams.append(messages.file_stream(spark, str(tmp_path / name), df.schema))
    joined = queries.attribution_stream(*streams, "7 days", unfollowed=True)
    queries.run(joined, "unfollowed", str(tmp_path / "ck"), sinks.batch_log(str(tmp_path / "log")), "append")
    got = sorted((r.user_id, r.content_id, r.event_id or "") for r in spark.read.parquet(str(tmp_path / "log")).collect())
    # The last recommendation's time is not over yet.
    assert got == [("u", "c1", "e1"), ("u", "c1", "e2"), ("u", "c2", ""), ("v", "c1", "")]


def test_state_is_kept_on_disk_in_a_session_that_says_nothing_of_it(spark, tmp_path):
    folder = Folder(spark, tmp_path / "events")
    folder.add(spark.createDataFrame(event_rows([("s", "00:00:10")], 0), EVENT))
    plain = spark.newSession()
    for key in STATE_CONF:
        plain.conf.unset(key)
    log, checkpoint = str(tmp_path / "log"), tmp_path / "ck"
    queries.run(queries.session_stream(stream_of(plain, folder)), "on-disk", str(checkpoint), sinks.batch_log(log))
    assert ROCKSDB_PROVIDER in (checkpoint / "offsets" / "0").read_text()
    assert [plain.conf.get(key, None) for key in STATE_CONF] == [None] * len(STATE_CONF)
    plain.conf.set("spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB", "77")
    with state_on_disk(plain):
        kept = {key: plain.conf.get(key) for key in STATE_CONF}
    assert kept == STATE_CONF | {"spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "77"}
    plain.conf.set("spark.sql.streaming.stateStore.providerClass", "another.Provider")
    with state_on_disk(plain):
        assert plain.conf.get("spark.sql.streaming.join.stateFormatVersion", None) is None


def test_a_join_keeps_its_state_in_one_store_a_partition(spark, tmp_path):
    at = datetime.datetime.fromisoformat("2026-01-01 10:00")
    recs = spark.createDataFrame([("u", "c", at)], "user_id string, content_id string, created_at timestamp")
    events = spark.createDataFrame(
        [("e", "u", "c", "click", at)], "event_id string, user_id string, content_id string, event_type string, timestamp_ts timestamp"
    )
    streams = []
    for name, df in (("recs", recs), ("events", events)):
        df.write.parquet(str(tmp_path / name))
        streams.append(messages.file_stream(spark, str(tmp_path / name), df.schema))
    queries.run(queries.attribution_stream(*streams), "one-store", str(tmp_path / "ck"), sinks.batch_log(str(tmp_path / "log")), "append")
    assert [r.event_id for r in spark.read.parquet(str(tmp_path / "log")).collect()] == ["e"]
    stores = [place.name for place in (tmp_path / "ck" / "state" / "0" / "0").iterdir() if place.is_dir()]
    assert not [name for name in stores if name.startswith(("left-", "right-"))]


def test_staged_events_come_in_few_batches_of_many_files(spark, tmp_path, monkeypatch):
    from catalog import streams

    monkeypatch.setattr(streams, "shared_folder", lambda spark, name: str(tmp_path / name))
    monkeypatch.setattr(streams, "STAGED_ROWS", 50)
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    folder = str(tmp_path / "in")
    events.repartition(12).write.parquet(f"{folder}/events.parquet")
    assert streams.stream_samples(spark, folder).count() == sinks.SAMPLE_ROWS
    streams.stream_ingest_out_of_order(spark, folder)
    for name in ("samples", "out-of-order"):
        assert len(list((tmp_path / name / "events").glob("batch_id=*"))) == 4
        files = spark.read.parquet(str(tmp_path / name / "staged")).groupBy(F.input_file_name()).count().collect()
        assert sum(r["count"] for r in files) == events.count() and max(r["count"] for r in files) <= 200


def test_recorder_adds_up_what_queries_observe(spark, tmp_path):
    folder = Folder(spark, tmp_path / "messages")
    folder.add(as_messages(spark, [value for value, _ in CASES]))
    raw = messages.file_stream(spark, str(folder.path))
    recorder = metrics.ProgressRecorder()
    spark.streams.addListener(recorder)
    try:
        writer = sinks.ingest_writer(str(tmp_path / "ev"), str(tmp_path / "dl"))
        queries.run(queries.counted(queries.ingest_stream(raw)), "observed", str(tmp_path / "ck"), writer, "append")
        last = {}
        for _ in range(50):  # progress comes on a thread of its own
            last |= {r.metric_name: r.metric_value for r in recorder.take(spark).orderBy("timestamp").collect()}
            if metrics.SAVED in last:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(recorder)
    good = sum(reason is None for _, reason in CASES)
    assert last[metrics.SAVED] == good and last[metrics.PARSE_ERRORS] == len(CASES) - good
    assert last[metrics.CONSUMED] >= len(CASES)


def test_messages_out_of_order_of_their_times_are_all_stored(spark, tmp_path):
    folder = Folder(spark, tmp_path / "messages")
    batches = [("12:00", ["e1"]), ("12:01", ["e2"]), ("09:00", ["e3", None])]
    for at, ids in batches:
        values = [json.dumps({**SAMPLE, "event_id": i}) if i else "broken" for i in ids]
        folder.add(as_messages(spark, values).withColumn("timestamp", F.lit(f"2026-02-14 {at}:00").cast("timestamp")))
    raw = messages.file_stream(spark, str(folder.path), max_files_per_trigger=1)
    queries.start_ingest(raw, str(tmp_path / "ck"), str(tmp_path / "ev"), str(tmp_path / "dl"), every=None).awaitTermination()
    assert {r.event_id for r in sinks.current_events(spark, str(tmp_path / "ev")).collect()} == {"e1", "e2", "e3"}
    assert spark.read.parquet(str(tmp_path / "dl")).count() == 1


def test_first_arrival_of_an_event_wins_whatever_the_batch(spark, tmp_path):
    folder = Folder(spark, tmp_path / "messages")
    for at, content in (("12:00", "later"), ("09:00", "first")):
        message = as_messages(spark, [json.dumps({**SAMPLE, "content_id": content})])
        folder.add(message.withColumn("timestamp", F.lit(f"2026-02-14 {at}:00").cast("timestamp")))
    raw = messages.file_stream(spark, str(folder.path), max_files_per_trigger=1)
    queries.start_ingest(raw, str(tmp_path / "ck"), str(tmp_path / "ev"), str(tmp_path / "dl"), every=None).awaitTermination()
    (row,) = sinks.current_events(spark, str(tmp_path / "ev")).collect()
    assert row.content_id == "first"


def test_events_of_a_failed_batch_become_letters_before_the_query_fails(spark, tmp_path, monkeypatch):
    folder = Folder(spark, tmp_path / "messages")
    folder.add(as_messages(spark, [json.dumps(SAMPLE)]))
    raw = messages.file_stream(spark, str(folder.path))
    real, failures = sinks.write_batch, []

    def broken(df, path, batch_id, partition_by=()):
        if path.endswith("ev"):
            raise OSError("store down")
        real(df, path, batch_id, partition_by)

    monkeypatch.setattr(sinks, "write_batch", broken)
    monkeypatch.setattr(sinks.time, "sleep", lambda seconds: None)
    query = queries.start_ingest(
        raw, str(tmp_path / "ck"), str(tmp_path / "ev"), str(tmp_path / "dl"), every=None, name="failing",
        on_failure=failures.append, failed_path=str(tmp_path / "failed"),
    )
    with pytest.raises(Exception, match="store down"):
        query.awaitTermination()
    (letter,) = spark.read.parquet(str(tmp_path / "failed")).collect()
    assert letter.error_type == "MySQLSaveError" and json.loads(letter.event)["event_id"] == SAMPLE["event_id"]
    assert len(failures) == 3


def test_lenient_time_is_selectable(spark, tmp_path):
    folder = Folder(spark, tmp_path / "messages")
    folder.add(as_messages(spark, [json.dumps({**SAMPLE, "timestamp": "yesterday"})]))
    raw = messages.file_stream(spark, str(folder.path))
    queries.start_ingest(
        raw, str(tmp_path / "ck"), str(tmp_path / "ev"), str(tmp_path / "dl"), every=None, name="lenient", lenient_time=True
    ).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "ev")).count() == 1


def test_started_queries_go_from_messages_to_tables(spark, tmp_path):
    folder = Folder(spark, tmp_path / "messages")
    folder.add(as_messages(spark, [value for value, _ in CASES]))
    raw = messages.file_stream(spark, str(folder.path))
    log = str(tmp_path / "log")
    queries.start_sessions(raw, str(tmp_path / "ck1"), log, every=None).awaitTermination()
    # One accepted case has a blank user and so a session row of its own.
    got = {r.user_id: r.event_count for r in sinks.current_sessions(spark, log).collect()}
    assert got == {"user-00042": sum(r is None for _, r in CASES) - 1, "   ": 1}
    queries.start_ingest(raw, str(tmp_path / "ck2"), str(tmp_path / "ev"), str(tmp_path / "dl"), every=None).awaitTermination()
    assert sinks.current_events(spark, str(tmp_path / "ev")).count() == 1


def test_json_line_files_stream_with_all_their_rejects(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text("\n".join([json.dumps(SAMPLE), "{}", "{}", "bad", json.dumps(SAMPLE)]) + "\n")
    raw = messages.json_lines_stream(spark, str(tmp_path / "in"))
    query = queries.start_ingest(raw, str(tmp_path / "ck"), str(tmp_path / "ev"), str(tmp_path / "dl"), every=None)
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "ev")).count() == 2
    assert sinks.current_events(spark, str(tmp_path / "ev")).count() == 1
    assert spark.read.parquet(str(tmp_path / "dl")).count() == 3


def test_a_timed_trigger_keeps_the_query_running(spark, tmp_path, late_folder):
    log = str(tmp_path / "log")
    query = queries.start(
        queries.session_stream(stream_of(spark, late_folder)), "timed", str(tmp_path / "ck"), sinks.batch_log(log),
        "update", every="1 second",
    )
    try:
        query.processAllAvailable()
        assert query.isActive
        sessions = sinks.current_sessions(spark, log)
        assert [r.session_id for r in active_sessions(sessions, 180).collect()] == ["s2"]
    finally:
        query.stop()


def test_heat_map_of_a_stream_counts_viewers_approximately(spark, tmp_path, late_folder):
    stream = queries.with_watermark(stream_of(spark, late_folder), "10 minutes")
    log = str(tmp_path / "log")
    queries.run(heat_map(stream, "1 day"), "heat", str(tmp_path / "ck"), sinks.batch_log(log), "update")
    rows = sinks.current_rows(spark, log, ["content_id", "bucket_start"]).collect()
    assert len(rows) == 8 and all((r.views, r.viewers, r.minutes) == (1, 1, 5) for r in rows)


def test_jdbc_sink_replaces_windows_at_their_key(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(sinks, "replace_jdbc", lambda df, url, table, key, staging, *rest: calls.append((df, url, table, key, staging)))
    sessions = session_windows(spark.createDataFrame(event_rows([row for batch in LATE for row in batch], 0), EVENT))
    sinks.session_jdbc_writer("jdbc:x")(sessions, 0)
    ((df, url, table, key, staging),) = calls
    assert (url, table, staging) == ("jdbc:x", "user_sessions", "user_sessions_staging")
    assert df.count() == df.select(*key).distinct().count() == 3


def test_strict_and_lax_event_streams(spark):
    df = as_messages(spark, [value for value, _ in CASES])
    strict = queries.events_from_messages(df).count()
    assert strict == sum(reason is None for _, reason in CASES)
    assert queries.events_from_messages(df, strict=False).count() == len(CASES)


def test_retries_pause_and_then_raise():
    pauses, failures, calls = [], [], []

    def broken():
        calls.append(1)
        raise OSError("no")

    with pytest.raises(OSError):
        sinks.with_retries(broken, on_failure=failures.append, sleep=pauses.append)
    assert (len(calls), pauses, len(failures)) == (3, [1.0, 2.0], 3)

    def works_second_time():
        calls.append(1)
        if len(calls) == 4:
            raise OSError("once")

    sinks.with_retries(works_second_time, sleep=pauses.append)
    assert len(calls) == 5
