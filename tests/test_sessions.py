import datetime
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import moment
from watchlens.operators import sessions, stats


def only(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def lists(row):
    return [sorted(row[name]) for name in sessions.LISTS]


FIELDS = [
    ("e1", "u", "s", "click", "content-browse-001", 0, "10:00:00"),
    ("e2", "u", "s", "watch", "content-watch-001", 15, "10:00:35"),
    ("e3", "u", "s", "watch", "content-watch-002", 20, "10:00:40"),
    ("e4", "u", "s", "watch_complete", "content-watch-001", 120, "10:00:45"),
]


def test_fields_of_a_session(make_events):
    row = only(sessions.session_summary(make_events(FIELDS)))
    assert (row.event_count, row.total_watched_minutes, row.watch_minutes) == (4, 155, 35)
    assert lists(row) == [["content-browse-001"], ["content-watch-001", "content-watch-002"], ["content-watch-001"]]
    assert (row.start_time, row.end_time) == (moment("10:00:00"), moment("10:00:45"))


def test_initial_and_delayed_events_of_a_session(make_events):
    initial = [("e0", "u", "s", "click", "c", 0, "10:00:00")] + [
        (f"e{i}", "u", "s", "watch", f"c{i}", 5, "10:00:00") for i in range(1, 5)
    ]
    delayed = [(f"d{i}", "u", "s", "watch", f"d{i}", 10, "10:01:00") for i in range(5)]
    first = only(sessions.session_windows(make_events(initial), "30 seconds"))
    assert (first.event_count, first.total_watched_minutes) == (5, 20)
    windows = sessions.session_windows(make_events(initial + delayed), "30 seconds")
    assert sorted(r.event_count for r in windows.collect()) == [5, 5]
    whole = only(sessions.session_rollup(windows))
    assert (whole.event_count, whole.total_watched_minutes) == (10, 70)


def test_several_sessions(make_events):
    rows = []
    for s in range(3):
        rows.append((f"c{s}", "u", f"s{s}", "click", "c", 0, "10:00:00"))
        rows += [(f"w{s}{i}", "u", f"s{s}", "watch", f"c{i}", 5, "10:00:01") for i in range(2)]
    got = {r.session_id: (r.event_count, r.total_watched_minutes) for r in sessions.session_windows(make_events(rows)).collect()}
    assert got == {f"s{s}": (3, 10) for s in range(3)}


def test_watchlist_and_rating_count_but_fill_no_list(make_events):
    rows = [("a", "u", "s", "watchlist", "c1", 0, "10:00:00"), ("b", "u", "s", "rating", "c2", 7, "10:00:01")]
    row = only(sessions.session_windows(make_events(rows)))
    assert (row.event_count, row.total_watched_minutes) == (2, 7) and lists(row) == [[], [], []]


def test_events_without_time_are_left_out(make_events):
    rows = [("a", "u", "s", "click", "c1", 0, "10:00:00"), ("b", "u", "s", "click", "c2", 0, None)]
    assert only(sessions.session_windows(make_events(rows))).event_count == 1


def test_missing_minutes(make_events):
    events = make_events([("a", "u", "s", "click", "c1", None, "10:00:00")])
    assert only(sessions.session_windows(events)).total_watched_minutes == 0
    assert only(sessions.session_windows(events, null_minutes=True)).total_watched_minutes is None


def test_window_border_splits_a_session(make_events):
    rows = [("a", "u", "s", "click", "c1", 0, "10:02:59.999999"), ("b", "u", "s", "click", "c2", 0, "10:03:00")]
    got = sorted((r.window_start, r.window_end) for r in sessions.session_windows(make_events(rows)).collect())
    assert got == [(moment("10:00:00"), moment("10:03:00")), (moment("10:03:00"), moment("10:06:00"))]


def random_rows(seed, n=300):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        user = "hot" if rng.random() < 0.4 else f"u{rng.randrange(5)}"
        ts = (datetime.datetime(2026, 1, 1) + datetime.timedelta(seconds=rng.randrange(86400))).time().isoformat()
        rows.append((
            f"e{i:03d}", user, f"{user}-s{rng.randrange(3)}",
            rng.choice(["click", "watch", "watchlist", "watch_complete", "rating"]),
            f"c{rng.randrange(12)}", rng.choice([None, 0, 3, 40]), ts,
        ))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rollup_of_windows_equals_direct_summary(make_events, seed):
    events = make_events(random_rows(seed))
    def shape(df):
        return sorted((*[str(r[c]) for c in df.columns if c not in sessions.LISTS], *map(str, lists(r))) for r in df.collect())
    rolled = sessions.session_rollup(sessions.session_windows(events, "10 minutes"))
    direct = sessions.session_summary(events).select(rolled.columns)
    assert shape(rolled) == shape(direct)


def brute_gap_sessions(rows, gap):
    numbers = {}
    last, number = {}, {}
    for row in sorted(rows, key=lambda r: (r[6], r[0])):
        ts = moment(row[6])
        if row[1] not in last or (ts - last[row[1]]).total_seconds() >= gap:
            number[row[1]] = number.get(row[1], 0) + 1
        last[row[1]] = ts
        numbers[row[0]] = number[row[1]]
    return numbers


@pytest.mark.parametrize("seed, gap", [(1, 180), (2, 1800), (3, 7200), (4, 20000)])
def test_gap_sessions_equal_brute_force(make_events, seed, gap):
    rows = random_rows(seed)
    expected = brute_gap_sessions(rows, gap)
    events = make_events(rows)
    assert {r.event_id: r.session_no for r in sessions.session_starts(events, gap).collect()} == expected
    sizes = {}
    for row in rows:
        sizes[row[1], expected[row[0]]] = sizes.get((row[1], expected[row[0]]), 0) + 1
    got = {(r.user_id, r.session_no): r.event_count for r in sessions.gap_sessions(events, gap).collect()}
    assert got == sizes


def test_a_pause_of_exactly_the_gap_starts_a_session_where_sparks_window_merges(make_events):
    events = make_events([("a", "u", "s", "click", "c", 0, "10:00:00"), ("b", "u", "s", "click", "c", 0, "10:03:00")])
    assert sessions.gap_sessions(events, 180).count() == 2
    merged = events.groupBy("user_id", F.session_window("timestamp_ts", "180 seconds")).count()
    assert merged.count() == 1


def test_events_without_time_are_in_no_gap_session(make_events):
    events = make_events([("a", "u", "s", "click", "c", 0, "10:00:00"), ("b", "u", "s", "click", "c", 0, None)])
    assert only(sessions.gap_sessions(events)).event_count == 1
    numbers = {str(row.timestamp_ts): row.session_no for row in sessions.session_starts(events).collect()}
    assert len(numbers) == 2 and numbers["None"] is None and set(numbers.values()) == {1, None}


def test_rating_inherits_minutes_of_the_same_content_only(make_events):
    events = make_events([
        ("a", "u", "s", "watch", "c1", 30, "10:00:00"), ("b", "u", "s", "rating", "c1", 0, "10:00:10"),
        ("c", "u", "s", "watch", "c2", 20, "10:00:20"), ("d", "u", "s", "rating", "c1", 0, "10:00:30"),
        ("e", "v", "t", "rating", "c1", 0, "10:00:40"),
    ])
    got = {r.event_id: r.inherited_minutes for r in sessions.previous_event(events).collect()}
    assert got == {"a": 30, "b": 30, "c": 20, "d": 0, "e": 0}


def test_latest_queries(make_events):
    events = make_events(FIELDS)
    assert [r.event_id for r in sessions.user_events(events, "u", 2).collect()] == ["e4", "e3"]
    assert [r.event_id for r in sessions.session_events(events, "s").collect()] == ["e1", "e2", "e3", "e4"]
    assert sessions.analyze_session(events, "other").count() == 0
    assert {(r.event_id, r.recency) for r in sessions.latest_per_user(events, 2).collect()} == {("e4", 1), ("e3", 2)}


def test_active_sessions_by_gap_and_by_given_time(make_events):
    events = make_events([("a", "u", "s1", "click", "c", 0, "10:00:00"), ("b", "u", "s2", "click", "c", 0, "10:10:00")])
    summary = sessions.session_summary(events)
    assert [r.session_id for r in sessions.active_sessions(summary, 180).collect()] == ["s2"]
    later = F.lit(moment("11:00:00"))
    assert sessions.active_sessions(summary, 180, later).count() == 0


def test_table_rows_hold_json_lists(make_events):
    row = only(sessions.as_table_row(sessions.session_summary(make_events(FIELDS))))
    assert row.watched_contents == '["content-watch-001","content-watch-002"]'


def test_rewatch_and_watchlist(make_events, spark):
    events = make_events([
        ("a", "u", "s", "watch", "c1", 5, "10:00:00"), ("b", "u", "s", "watch_complete", "c1", 9, "11:00:00"),
        ("c", "u", "s", "watch", "c2", 5, "12:00:00"),
    ])
    assert {r.event_id: r.is_rewatch for r in stats.rewatches(events).collect()} == {"a": False, "b": True, "c": False}
    listed = make_events([
        ("a", "u", "s", "watchlist", "c1", 0, "10:00:00"), ("b", "u", "s", "watchlist", "c1", 0, "10:05:00"),
        ("c", "u", "s", "watchlist", "c2", 0, "10:00:00"),
    ]).withColumn("metadata", F.create_map(F.lit("action"), F.when(F.col("event_id") == "b", "remove").otherwise("add")))
    assert [r.content_id for r in stats.current_watchlist(listed).collect()] == ["c2"]


def test_window_lists_are_built_from_one_row_per_content(make_events):
    """The raw events meet their first shuffle by session and content, after a partial aggregation."""
    plan = sessions.session_windows(make_events(FIELDS))._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 2 and "content_id" in exchanges[-1] and "content_id" not in exchanges[0]
