"""Sketches, samples and working folders."""

import datetime
import hashlib
import random
from collections import defaultdict
from pathlib import Path

from pyspark.sql import functions as F

from watchlens.operators import sessions, stats
from watchlens.session import materialize, working_folder
from watchlens.streaming import sinks

START = datetime.datetime(2026, 1, 1)


def test_viewers_merge_from_hours_to_days(spark):
    rng = random.Random(1)
    rows = [
        (f"e{i}", f"u{rng.randrange(3000)}", f"c{rng.randrange(3)}", rng.choice(["watch", "click"]), 2, START + datetime.timedelta(minutes=rng.randrange(3 * 1440)))
        for i in range(20000)
    ]
    events = spark.createDataFrame(rows, "event_id string, user_id string, content_id string, event_type string, watched_minutes int, timestamp_ts timestamp_ntz")
    hourly = stats.viewer_sketches(events)
    exact = defaultdict(set)
    for _, user, content, kind, _, at in rows:
        if kind == "watch":
            exact[content, at.replace(hour=0, minute=0)].add(user)
    for keys, row in {(r.content_id, r.bucket_start): r for r in stats.merged_viewers(hourly, "day").collect()}.items():
        assert abs(row.viewers - len(exact[keys])) <= 0.02 * len(exact[keys])
    # Also over all contents, as batch and later hours come in parts.
    parts = hourly.where("bucket_start < '2026-01-02'").unionByName(hourly.where("bucket_start >= '2026-01-02'"))
    everyone = len(set().union(*exact.values()))
    (whole,) = stats.merged_viewers(parts, "month", ()).collect()
    assert abs(whole.viewers - everyone) <= 0.02 * everyone and whole.views == sum(r[3] == "watch" for r in rows)


def test_medians_of_merged_length_sketches_lie_in_the_middle(spark):
    rng = random.Random(2)
    seconds = [int(rng.lognormvariate(6, 2)) for _ in range(20000)]
    rows = [(f"s{i}", ("VIP", "New", None)[i % 3], START, START + datetime.timedelta(seconds=s)) for i, s in enumerate(seconds)]
    df = spark.createDataFrame(rows, "session_id string, user_segment string, start_time timestamp_ntz, end_time timestamp_ntz")
    sketches = sessions.length_sketches(df.withColumn("part", F.length("session_id")), "user_segment", "part")
    for row in sessions.merged_lengths(sketches, "user_segment").collect():
        own = sorted(s for i, s in enumerate(seconds) if ("VIP", "New", None)[i % 3] == row.user_segment)
        rank = sum(s <= row.median_seconds for s in own) / len(own)
        assert row.sessions == len(own) and abs(rank - 0.5) <= 0.017
    (whole,) = sessions.merged_lengths(sketches).collect()
    assert abs(sum(s <= whole.median_seconds for s in seconds) / len(seconds) - 0.5) <= 0.017


def test_samples_of_parts_make_the_sample_of_all(spark):
    rows = [(f"e{i:04d}", f"k{i % 3}") for i in range(900)]
    df = spark.createDataFrame(rows, "event_id string, kind string")
    parts = [stats.hash_sample(df.where(F.col("event_id").substr(2, 4).cast("int") % 4 == k), 6, "event_id", ["kind"]).drop("place") for k in range(4)]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    got = sorted((r.kind, r.place, r.event_id) for r in stats.hash_sample(merged, 6, "event_id", ["kind"]).collect())
    by_hash = lambda e: hashlib.sha256(e.encode()).hexdigest()
    want = [(f"k{k}", n + 1, e) for k in range(3) for n, e in enumerate(sorted((e for e, kind in rows if kind == f"k{k}"), key=by_hash)[:6])]
    assert got == sorted(want)
    assert len(stats.hash_sample(df, 10, "event_id").collect()) == 10


def test_working_folder_is_removed(spark):
    with working_folder(spark) as folder:
        with working_folder(spark) as inner:
            assert inner.startswith(folder) and materialize(spark.range(5), "x").count() == 5 and Path(inner).exists()
        assert not Path(inner).exists()
        assert materialize(spark.range(3), "x").count() == 3 and Path(folder).exists()
    assert not Path(folder).exists()


def test_log_folders_go_once_a_snapshot_holds_them(spark, tmp_path):
    log, out = str(tmp_path / "log"), str(tmp_path / "snapshot")
    rows = lambda k: spark.createDataFrame([("a", k), (f"b{k}", k)], "k string, v int")
    for k in range(3):
        sinks.write_batch(rows(k), log, k)
        sinks.write_snapshot(spark, log, ["k"], out)
    sinks.write_batch(rows(3), log, 3)
    assert sinks.retire_batches(spark, log, out) == 5  # three batches and two older snapshots
    assert sorted(p.name for p in (tmp_path / "log").glob("batch_id=*")) == ["batch_id=3"]
    now = {r.k: r.v for r in sinks.current_rows(spark, log, ["k"], out).collect()}
    assert now == {"a": 3, "b0": 0, "b1": 1, "b2": 2, "b3": 3}
    assert sinks.retire_batches(spark, log, out) == 0
