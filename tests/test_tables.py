import pytest
from pyspark.sql import functions as F

from watchlens.operators import quality, stats, tables
from watchlens.schemas import SEGMENT_TARGETS, TABLES


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def created(spark):
    return tables.create_tables(spark)


def test_tables_are_created_once_and_verified(spark, created):
    assert created == {name: True for name in TABLES}
    assert tables.create_tables(spark) == created
    report = tables.verify_tables(spark)
    assert report["all_tables_exist"] and report["user_events"] == {"exists": True, "missing": [], "extra": [], "type": []}


def test_verification_sees_missing_tables_and_columns(spark, created):
    spark.sql("CREATE TABLE IF NOT EXISTS old_events (user_id string, watched_minutes bigint, note string) USING parquet")
    TABLES["old_events"] = TABLES["user_events"]
    try:
        report = tables.verify_tables(spark, ["old_events"])["old_events"]
        assert "event_id" in report["missing"] and report["extra"] == ["note"] and report["type"] == ["watched_minutes"]
        added = tables.add_missing_columns(spark, "old_events")
        assert "event_id" in added and tables.add_missing_columns(spark, "old_events") == []
    finally:
        del TABLES["old_events"]
    TABLES["nowhere"] = TABLES["contents"]
    try:
        report = tables.verify_tables(spark, ["nowhere"])
        assert not report["all_tables_exist"] and not report["nowhere"]["exists"]
    finally:
        del TABLES["nowhere"]


def test_rows_go_in_with_defaults_and_come_back_by_key(spark, created):
    users = spark.createDataFrame([("user-00001", "VIP"), ("user-00002", "New")], "user_id string, user_segment string")
    tables.fill_defaults(users, TABLES["user_profiles"]).write.insertInto("user_profiles")
    (row,) = tables.read_table(spark, "user_profiles", user_id="user-00001").collect()
    assert (row.total_purchases, str(row.total_spent), row.favorite_categories) == (0, "0.00", None)
    assert row.created_at is not None and row.updated_at is not None


def test_events_are_appended_once(spark, created):
    from tests.test_ingest import CASES, as_messages
    from watchlens.operators.ingest import parse_messages

    parsed = parse_messages(as_messages(spark, [value for value, _ in CASES]))
    # All accepted cases carry the same event id.
    assert tables.append_events(spark, parsed) == 1
    assert tables.append_events(spark, parsed) == 0
    (row,) = tables.read_table(spark, "user_events", event_id="view-77").collect()
    assert row.watched_minutes == 31 and str(row.event_date) == "2026-02-14" and row.created_at is not None


def test_upsert_keeps_last_source_row(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    source = spark.createDataFrame([("b", 20, 1), ("b", 30, 2), ("c", 40, 1)], "k string, v int, version int")
    assert rows(tables.upsert(target, source, ["k"], ["version"])) == [("a", 1), ("b", 30), ("c", 40)]


def test_upsert_keeps_the_creation_time_of_known_rows(spark):
    target = spark.createDataFrame([("a", 1, "old"), ("b", 2, "old")], "k string, v int, created string")
    source = spark.createDataFrame([("b", 20, "new"), ("c", 30, "new")], "k string, v int, created string")
    got = rows(tables.upsert(target, source, ["k"], keep=("created",)))
    assert got == [("a", 1, "old"), ("b", 20, "old"), ("c", 30, "new")]


def test_stored_upsert_touches_only_its_buckets_and_repeats(spark, tmp_path):
    path = str(tmp_path / "users")
    tables.store_for_upsert(spark.createDataFrame([(f"u{i}", i) for i in range(40)], "k string, v int"), path, ["k"])
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "users").rglob("*.parquet")}
    source = spark.createDataFrame([("u1", 100), ("new", 7)], "k string, v int")
    for _ in range(2):
        tables.upsert_into(spark, path, source, ["k"])
        got = dict(rows(spark.read.parquet(path).select("k", "v")))
        assert got == {**{f"u{i}": i for i in range(40)}, "u1": 100, "new": 7}
    untouched = [p for p in before if p.exists()]
    assert len(untouched) >= len(before) - 2


def test_merge_statement():
    text = tables.merge_statement("users", "incoming", ["k", "v"], ["k"])
    assert text == (
        "MERGE INTO users AS t USING incoming AS s ON t.`k` = s.`k` WHEN MATCHED THEN UPDATE SET t.`v` = s.`v` "
        "WHEN NOT MATCHED THEN INSERT (`k`, `v`) VALUES (s.`k`, s.`v`)"
    )
    kept = tables.merge_statement("users", "incoming", ["k", "v", "created_at"], ["k"], ("created_at",))
    assert "UPDATE SET t.`v` = s.`v` WHEN" in kept and "s.`created_at`)" in kept


def test_delete_and_orphans(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "k string, v int")
    keys = spark.createDataFrame([("b",), ("b",)], "k string")
    assert rows(tables.delete_keys(df, keys, ["k"])) == [("a", 1)]
    assert rows(quality.orphan_rows(df, keys, "k")) == [("a", 1)]
    assert rows(quality.orphan_keys(df, keys, "k")) == [("a", 1)]
    assert rows(quality.known_rows(df, keys, "k")) == [("b", 2), ("b", 3)]


def test_event_ids_from_content(spark):
    old = spark.createDataFrame([("u", "c"), ("u", "d")], "user_id string, content_id string")
    ids = [r.event_id for r in tables.with_event_id(old).collect()]
    assert len(set(ids)) == 2 and all(len(i) == 64 for i in ids)
    mixed = spark.createDataFrame([("e1", "u"), (None, "u")], "event_id string, user_id string")
    got = [r.event_id for r in tables.with_event_id(mixed).collect()]
    assert got[0] == "e1" and len(got[1]) == 64


def test_rules(spark):
    contents = spark.createDataFrame(
        [("c1", "t", "movie", 3.0), (None, "t", "movie", 5.0), ("c" * 51, "t", "play", 5.1), ("c3", None, None, None)],
        "content_id string, title string, content_type string, rating double",
    )
    report = quality.rule_report(contents, quality.rules_of(TABLES["contents"], contents.columns))
    got = {r.rule: r.violations for r in report.collect()}
    assert got == {
        "content_id:required": 1, "title:required": 1, "content_type:required": 1, "content_type:domain": 1,
        "content_id:length": 1, "title:length": 0, "rating:range": 1,
    }


def test_distribution_reports_absent_and_other_values(spark):
    users = spark.createDataFrame([("VIP",), ("VIP",), ("Gold",), (None,)], "user_segment string")
    got = {r.value: (r["count"], r.percent, r.distance) for r in quality.distribution(users, "user_segment", SEGMENT_TARGETS).collect()}
    assert got == {"VIP": (2, 50.0, 30.0), "Regular": (0, 0.0, 50.0), "New": (0, 0.0, 30.0), "(other)": (2, 50.0, 50.0)}


def test_user_statistics_of_known_users(spark):
    users = spark.createDataFrame([(10, "100.50"), (20, "50.25")], "total_purchases int, s string").select(
        "total_purchases", F.col("s").cast("decimal(12,2)").alias("total_spent")
    )
    assert tuple(stats.user_statistics(users).first()) == (2, 15.0, 75.38, 150.75)


def test_duplicates(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "event_id string")
    assert rows(quality.duplicate_keys(df, ["event_id"])) == [("a", 2)]
