import json

import pytest
from pyspark.sql import functions as F

from watchlens.operators import ingest
from watchlens.sources import dimensions, messages, relational

SAMPLE = {
    "event_id": "view-77", "timestamp": "2026-02-14T20:15:07.250Z", "user_id": "user-00042",
    "session_id": "evening-9", "event_type": "watch", "content_id": "series-00310", "genre": "crime",
    "duration_minutes": 52, "watched_minutes": 31,
    "metadata": {"device": "tv", "ab_test_group": "B", "release_year": 2011, "nested": {"a": 1}},
}


def without(name):
    return {k: v for k, v in SAMPLE.items() if k != name}


def as_messages(spark, values):
    rows = [
        (b"k", v if v is None or isinstance(v, bytes) else v.encode(), "t", 0, i) for i, v in enumerate(values)
    ]
    df = spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, offset bigint")
    return df.withColumn("timestamp", F.lit("2026-02-14 20:16:00").cast("timestamp"))


CASES = [
    (json.dumps(SAMPLE), None),
    ("{half a record", "bad_json"),
    ('{"event_id": "x"', "bad_json"),
    ("", "bad_json"),
    ("  ", "bad_json"),
    (None, "bad_json"),
    (json.dumps(SAMPLE) + " tail", "bad_json"),
    (json.dumps({**SAMPLE, "metadata": 5}), None),
    (json.dumps(without("user_id")), "missing:user_id"),
    (json.dumps({**SAMPLE, "event_type": "paused"}), "bad_event_type"),
    (json.dumps({**SAMPLE, "event_type": "watching"}), "bad_event_type"),
    (json.dumps({**SAMPLE, "content_id": ""}), "missing:content_id"),
    (json.dumps({**SAMPLE, "session_id": None}), "missing:session_id"),
    ("null", "not_object"),
    (json.dumps([SAMPLE]), "not_object"),
    ("42", "not_object"),
    ('"text"', "not_object"),
    ("{}", "missing:event_id,timestamp,user_id,session_id,event_type,content_id"),
    (json.dumps({**SAMPLE, "timestamp": "yesterday"}), "bad_timestamp"),
    (json.dumps({**SAMPLE, "timestamp": "2026-02-14T20:15:07"}), None),
    (json.dumps({**SAMPLE, "watched_minutes": "7"}), None),
    (json.dumps({**SAMPLE, "watched_minutes": "seven"}), None),
    (json.dumps(without("metadata")), None),
    (json.dumps({**SAMPLE, "user_id": "   "}), None),
    ("  " + json.dumps(SAMPLE), None),
]


def test_reject_reasons(spark):
    parsed = ingest.parse_messages(as_messages(spark, [value for value, _ in CASES]))
    got = {r.offset: r.reject_reason for r in parsed.collect()}
    assert got == {i: reason for i, (_, reason) in enumerate(CASES)}


def test_fields_of_an_accepted_event(spark):
    row = ingest.parse_messages(as_messages(spark, [json.dumps(SAMPLE)])).first()
    assert (row.event_id, row.watched_minutes, row.duration_minutes) == ("view-77", 31, 52)
    assert row.metadata["release_year"] == "2011" and json.loads(row.metadata["nested"]) == {"a": 1}


def test_unreadable_number_costs_only_its_field(spark):
    row = ingest.parse_messages(as_messages(spark, [json.dumps({**SAMPLE, "watched_minutes": "seven"})])).first()
    assert row.watched_minutes is None and row.duration_minutes == 52 and row.reject_reason is None


def test_lax_decoding_checks_nothing(spark):
    values = [json.dumps(SAMPLE), "{half a record", json.dumps({**SAMPLE, "event_type": "other"})]
    rows = ingest.add_event_time(ingest.decode_events(as_messages(spark, values))).collect()
    assert [r.event_type for r in rows] == ["watch", None, "other"]
    assert [r.timestamp_ts is None for r in rows] == [False, True, False]


def test_dead_letters_keep_envelope_and_whole_text(spark):
    long = "x" * 900
    parsed = ingest.parse_messages(as_messages(spark, [json.dumps(SAMPLE), long]))
    letters = ingest.dead_letters(parsed)
    assert letters.columns == [
        "timestamp", "error_type", "error_message", "topic", "partition", "offset", "key", "raw_value",
    ]
    (letter,) = letters.collect()
    assert (letter.error_type, letter.error_message, letter.offset) == ("MessageProcessingError", "bad_json", 1)
    assert letter.raw_value == long


def test_failed_saves_carry_the_event(spark):
    good = ingest.stored_event(ingest.accepted(ingest.parse_messages(as_messages(spark, [json.dumps(SAMPLE)]))))
    (letter,) = ingest.failed_saves(good, "down").collect()
    assert letter.error_type == "MySQLSaveError" and json.loads(letter.event)["event_id"] == "view-77"


def test_lenient_time_policy_uses_now(spark):
    bad = json.dumps({**SAMPLE, "timestamp": "yesterday"})
    row = ingest.use_now_for_bad_time(ingest.parse_messages(as_messages(spark, [bad]))).first()
    assert row.reject_reason is None and row.timestamp_ts is not None


def test_first_copy_of_an_event_wins_and_stored_ones_are_left_out(spark):
    values = [json.dumps({**SAMPLE, "event_id": e, "content_id": c}) for e, c in (("a", "1"), ("b", "2"), ("a", "3"))]
    good = ingest.first_per_event(ingest.accepted(ingest.parse_messages(as_messages(spark, values))), ["timestamp_ts", "offset"])
    assert {(r.event_id, r.content_id) for r in good.collect()} == {("a", "1"), ("b", "2")}
    stored = spark.createDataFrame([("b",)], "event_id string")
    assert [r.event_id for r in ingest.not_yet_stored(good, stored).collect()] == ["a"]


def test_stored_event_fills_defaults_and_skips_events_without_id(spark):
    df = spark.createDataFrame(
        [("e", None, None, None, None, None, None), ("", "u", "s", "click", "c", 1, {"a": "b"})],
        "event_id string, user_id string, session_id string, event_type string, content_id string, "
        "watched_minutes int, metadata map<string,string>",
    ).withColumn("timestamp_ts", F.lit("2026-02-14 20:16:00").cast("timestamp_ntz"))
    (row,) = ingest.stored_event(df).collect()
    assert tuple(row)[:6] == ("e", "", "", "", "", 0) and row.metadata == "{}" and str(row.event_date) == "2026-02-14"


def test_counts_of_a_batch(spark):
    parsed = ingest.parse_messages(as_messages(spark, [value for value, _ in CASES]))
    rejects = sum(reason is not None for _, reason in CASES)
    assert ingest.ingest_counts(parsed).first().asDict() == {
        "consumed": len(CASES), "saved": len(CASES) - rejects, "errors": rejects,
    }


def test_filters_do_not_repeat_the_parse(spark):
    parsed = ingest.accepted(ingest.parse_messages(as_messages(spark, [json.dumps(SAMPLE)])))
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_users_from_a_json_list(spark, tmp_path):
    path = tmp_path / "users.json"
    path.write_text(json.dumps([
        {"user_id": " user-00001 ", "user_segment": "VIP", "signup_date": "2023-08-02", "total_purchases": 44,
         "total_spent": 1100.04, "favorite_categories": '["SF", "역사"]'},
        {"user_id": "user-00002", "favorite_categories": ["드라마", " "]},
        {"user_id": "user-00003", "user_segment": "  ", "favorite_categories": None},
        {"user_id": "  "}, {"user_segment": "VIP"}, "text", 7,
    ], ensure_ascii=False), encoding="utf-8")
    rows = {r.user_id: r for r in dimensions.read_users(spark, str(path)).collect()}
    assert set(rows) == {"user-00001", "user-00002", "user-00003"}
    assert rows["user-00001"].favorite_categories == ["SF", "역사"]
    assert str(rows["user-00001"].total_spent) == "1100.04" and rows["user-00001"].total_purchases == 44
    assert (rows["user-00002"].user_segment, rows["user-00002"].favorite_categories) == ("Unknown", ["드라마"])
    assert rows["user-00003"].user_segment == "Unknown"


def test_users_file_without_users_is_an_error(spark, tmp_path):
    path = tmp_path / "users.json"
    path.write_text('[{"user_id": ""}]')
    with pytest.raises(ValueError):
        dimensions.read_users(spark, str(path))


def test_contents_with_unreadable_numbers_are_dropped(spark, tmp_path):
    path = tmp_path / "contents.json"
    path.write_text(json.dumps([
        {"content_id": "movie-00001", "title": "A", "duration_minutes": "90", "rating": 3.5, "release_year": None},
        {"content_id": "movie-00002", "duration_minutes": "long"},
        {"content_id": "movie-00003", "rating": "", "review_count": 0},
        {"content_id": ""},
    ]))
    rows = {r.content_id: r for r in dimensions.read_contents(spark, str(path)).collect()}
    assert set(rows) == {"movie-00001", "movie-00003"}
    assert (rows["movie-00001"].duration_minutes, rows["movie-00001"].release_year) == (90, 0)
    assert (rows["movie-00003"].rating, rows["movie-00003"].title) == (0.0, "")


def test_json_lines_as_messages(spark, tmp_path):
    (tmp_path / "events.jsonl").write_text(json.dumps(SAMPLE) + "\n{half a record\n")
    parsed = ingest.parse_messages(messages.json_lines(spark, str(tmp_path / "events.jsonl")))
    assert sorted(str(r.reject_reason) for r in parsed.collect()) == ["None", "bad_json"]


def test_json_output_keeps_script_and_nulls(spark, tmp_path):
    out = str(tmp_path / "out")
    relational.write_json(spark.createDataFrame([("드라마", None)], "a string, b string"), out)
    text = "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "out").glob("part-*"))
    assert json.loads(text) == {"a": "드라마", "b": None} and "드라마" in text


def test_kafka_options():
    assert messages.kafka_options("h:9092", "t")["startingOffsets"] == "earliest"
    assert messages.kafka_options("h:9092", "t", "latest")["startingOffsets"] == "latest"


def test_jdbc_append_bounds_its_connections():
    calls = {}

    class Writer:
        def option(self, name, value):
            calls[name] = value
            return self

        def jdbc(self, url, table, mode, properties):
            calls.update(url=url, table=table, mode=mode, properties=properties)

    class Frame:
        write = Writer()

    relational.append_jdbc(Frame(), "jdbc:x", "user_sessions", {"user": "u"}, connections=4)
    assert calls["numPartitions"] == 4 and calls["mode"] == "append" and calls["table"] == "user_sessions"
    assert calls["properties"]["user"] == "u" and calls["properties"]["batchsize"] == "1000"


def test_replacing_rows_matches_keys_and_nulls():
    import duckdb

    statements = relational.replace_statements("t", "s", ["k", "w", "v"], ["k", "w"])
    with duckdb.connect() as connection:
        for name in "ts":
            connection.execute(f"CREATE TABLE {name} (k TEXT, w INTEGER, v INTEGER)")
        connection.execute("INSERT INTO t VALUES ('a', 1, 1), (NULL, 1, 1), ('b', NULL, 1), (NULL, NULL, 1)")
        connection.execute("INSERT INTO s VALUES (NULL, 1, 2), ('b', NULL, 2), ('c', NULL, 2)")
        for _ in range(2):
            for text in statements:
                connection.execute(text)
            rows = connection.execute("SELECT * FROM t ORDER BY k NULLS FIRST, w NULLS FIRST").fetchall()
            assert rows == [(None, None, 1), (None, 1, 2), ("a", 1, 1), ("b", None, 2), ("c", None, 2)]
