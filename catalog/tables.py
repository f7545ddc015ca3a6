"""Table and data-quality queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.sqltext import CONTENTS, EV, RECS, USERS, with_
from watchlens.operators import quality, stored, tables
from watchlens.schemas import CONTENT_TYPE_TARGETS, SEGMENT_TARGETS, TABLES
from watchlens.session import shared_folder
from watchlens.sources import testbed


def _user_rows(spark: SparkSession, folder: str) -> DataFrame:
    return testbed.user_profiles(spark, folder).select("user_id", "user_segment", "total_purchases", "total_spent")


def _number(column: str) -> Column:
    return F.substring_index(column, "-", -1).cast("int")


def upsert_users(spark: SparkSession, folder: str) -> DataFrame:
    """Odd users get two updates of which the later wins, every tenth user comes in anew."""
    target = _user_rows(spark, folder)
    n = _number("user_id")
    round_one = target.where(n % 2 == 1).withColumn("version", F.lit(1))
    round_two = target.where(n % 2 == 1).withColumn("total_purchases", F.col("total_purchases") + 1000).withColumn("version", F.lit(2))
    fresh = target.where(n % 10 == 0).withColumn("user_id", F.concat("user_id", F.lit("-new"))).withColumn("version", F.lit(1))
    source = round_one.unionByName(round_two).unionByName(fresh)
    result = tables.upsert(target, source, ["user_id"], ["version"])
    return result.withColumn("total_spent", F.col("total_spent").cast("double"))


def upsert_contents(spark: SparkSession, folder: str) -> DataFrame:
    target = testbed.contents(spark, folder).select("content_id", "title", "genre", "duration_minutes", "review_count")
    source = target.where(F.col("genre") == "PROMO").withColumn("review_count", F.col("review_count") + 1)
    return tables.upsert(target, source, ["content_id"])


def delete_by_key(spark: SparkSession, folder: str) -> DataFrame:
    """Sessions of VIP users are deleted."""
    events = testbed.user_events(spark, folder)
    sessions = events.groupBy("session_id", "user_id").agg(F.count(F.lit(1)).alias("event_count"))
    gone = testbed.user_profiles(spark, folder).where(F.col("user_segment") == "VIP")
    return tables.delete_keys(sessions, gone, ["user_id"])


def stored_upsert_users(spark: SparkSession, folder: str) -> DataFrame:
    """The updates of `upsert_users`, put into a stored table in two writes, read back after buckets were split."""
    path, target, n = shared_folder(spark, "users"), _user_rows(spark, folder), _number("user_id")
    stored.create(target, path, ["user_id"], 16)
    changed = target.where(n % 2 == 1).withColumn("total_purchases", F.col("total_purchases") + 1000)
    stored.upsert(spark, path, changed)
    stored.split_buckets(spark, path)
    stored.upsert(spark, path, target.where(n % 10 == 0).withColumn("user_id", F.concat("user_id", F.lit("-new"))))
    return stored.read(spark, path).withColumn("total_spent", F.col("total_spent").cast("double"))


def stored_delete_sessions(spark: SparkSession, folder: str) -> DataFrame:
    """Sessions of VIP users are deleted from a stored table."""
    path = shared_folder(spark, "sessions")
    events = testbed.user_events(spark, folder)
    stored.create(events.groupBy("session_id", "user_id").agg(F.count(F.lit(1)).alias("event_count")), path, ["session_id", "user_id"])
    gone = testbed.user_profiles(spark, folder).where(F.col("user_segment") == "VIP")
    stored.delete(spark, path, stored.read(spark, path).join(gone, "user_id", "left_semi"))
    return stored.read(spark, path)


def stored_append_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events come in three overlapping writes, each stored once."""
    path = shared_folder(spark, "events")
    events = testbed.user_events(spark, folder).select("event_id", "event_type", "user_id")
    stored.create(events.where(F.col("event_type") == "click"), path, ["event_id"], 16)
    for kinds in (["click", "watch"], ["watch", "watch_complete", "rating", "watchlist"]):
        stored.append_new(spark, path, events.where(F.col("event_type").isin(kinds)))
    return stored.read(spark, path)


def dq_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """(user, content, type) triples stored more than once."""
    return quality.duplicate_keys(testbed.user_events(spark, folder), ["user_id", "content_id", "event_type"])


def dq_unique_event_ids(spark: SparkSession, folder: str) -> DataFrame:
    return quality.duplicate_keys(testbed.user_events(spark, folder), ["event_id"])


def dq_rules(spark: SparkSession, folder: str) -> DataFrame:
    frames = {
        "user_events": testbed.user_events(spark, folder).withColumn("timestamp", F.col("timestamp_ts")),
        "user_profiles": testbed.user_profiles(spark, folder),
        # Stretched ratings, so that the range rule has something to find.
        "contents": testbed.contents(spark, folder).withColumn("rating", F.col("rating") * 1.5),
        "recommendations": testbed.recommendations(spark, folder),
    }
    reports = [
        quality.rule_report(df, quality.rules_of(TABLES[name], df.columns)).withColumn("table_name", F.lit(name))
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, reports)


def dq_distribution(spark: SparkSession, folder: str) -> DataFrame:
    users = quality.distribution(testbed.user_profiles(spark, folder), "user_segment", SEGMENT_TARGETS)
    kinds = quality.distribution(testbed.contents(spark, folder), "content_type", CONTENT_TYPE_TARGETS)
    return users.unionByName(kinds)


def orphan_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events of contents outside the catalogue of movies."""
    movies = testbed.contents(spark, folder).where(F.col("content_type") == "movie")
    return quality.orphan_rows(testbed.user_events(spark, folder), movies, "content_id").select("event_id", "content_id")


def orphan_contents(spark: SparkSession, folder: str) -> DataFrame:
    movies = testbed.contents(spark, folder).where(F.col("content_type") == "movie")
    return quality.orphan_keys(testbed.user_events(spark, folder), movies, "content_id")


def known_user_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events of users in the VIP list."""
    vips = testbed.user_profiles(spark, folder).where(F.col("user_segment") == "VIP")
    return quality.known_rows(testbed.user_events(spark, folder), vips, "user_id").select("event_id", "user_id")


def schema_verify(spark: SparkSession, folder: str) -> DataFrame:
    """The check tables' columns held against the table definitions."""
    frames = {
        "user_profiles": testbed.user_profiles(spark, folder),
        "contents": testbed.contents(spark, folder),
        "recommendations": testbed.recommendations(spark, folder),
    }
    reports = [quality.schema_report(df, TABLES[name]) for name, df in frames.items()]
    return reduce(DataFrame.unionByName, reports)


def evolve_add_event_id(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of a table without event ids, given ids from their content."""
    old = testbed.user_events(spark, folder).select("user_id", "content_id", "event_type", "watched_minutes")
    return tables.with_event_id(old)


def row_defaults(spark: SparkSession, folder: str) -> DataFrame:
    """Profiles whose purchases are unknown for one segment, as stored."""
    users = _user_rows(spark, folder).withColumn(
        "total_purchases", F.when(F.col("user_segment") != "New", F.col("total_purchases"))
    )
    moment = F.expr("TIMESTAMP_NTZ'2024-02-01 00:00:00'")
    stored = tables.fill_defaults(users, TABLES["user_profiles"], moment)
    return stored.select("user_id", "total_purchases", F.col("total_spent").cast("double").alias("total_spent"), "created_at", "updated_at")


QUERIES = {
    "upsert_users": upsert_users,
    "upsert_contents": upsert_contents,
    "delete_by_key": delete_by_key,
    "stored_upsert_users": stored_upsert_users,
    "stored_delete_sessions": stored_delete_sessions,
    "stored_append_events": stored_append_events,
    "dq_duplicates": dq_duplicates,
    "dq_unique_event_ids": dq_unique_event_ids,
    "dq_rules": dq_rules,
    "dq_distribution": dq_distribution,
    "orphan_events": orphan_events,
    "orphan_contents": orphan_contents,
    "known_user_events": known_user_events,
    "schema_verify": schema_verify,
    "evolve_add_event_id": evolve_add_event_id,
    "row_defaults": row_defaults,
}


def _rule(table: str, relation: str, rule: str, broken: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{rule}' AS rule, count(*) AS checked, "
        f"count(*) FILTER ({broken}) AS violations FROM {relation}"
    )


def _rules_sql() -> str:
    relations = {"user_events": "events_named", "user_profiles": "users", "contents": "stretched", "recommendations": "recs"}
    present = {
        "user_events": "event_id user_id session_id event_type content_id timestamp",
        "user_profiles": "user_id user_segment",
        "contents": "content_id title content_type genre sub_genre rating",
        "recommendations": "user_id content_id recommendation_score algorithm ab_test_group",
    }
    lines = []
    for name, relation in relations.items():
        spec = TABLES[name]
        have = present[name].split()
        lines += [_rule(name, relation, f"{c}:required", f"{c} IS NULL") for c in spec.required if c in have]
        for c, values in spec.domains.items():
            lines.append(_rule(name, relation, f"{c}:domain", f"{c} NOT IN ({', '.join(repr(v) for v in values)})"))
        lines += [_rule(name, relation, f"{c}:length", f"length({c}) > {n}") for c, n in spec.max_length.items() if c in have]
        lines += [
            _rule(name, relation, f"{c}:range", f"{c} < {low} OR {c} > {high}")
            for c, (low, high) in spec.ranges.items() if c in have
        ]
    return with_(
        EV, USERS, CONTENTS, RECS,
        "events_named AS (SELECT *, ts AS timestamp FROM ev)",
        "stretched AS (SELECT * REPLACE (rating * 1.5 AS rating) FROM contents)",
    ) + "\nUNION ALL ".join(lines)


def _distribution_sql() -> str:
    lines = []
    for relation, column, targets in (
        ("users", "user_segment", SEGMENT_TARGETS), ("contents", "content_type", CONTENT_TYPE_TARGETS),
    ):
        names = ", ".join(f"'{name}'" for name in targets)
        for value, percent in [*targets.items(), ("(other)", 0.0)]:
            hit = f"{column} NOT IN ({names})" if value == "(other)" else f"{column} = '{value}'"
            lines.append(
                f"""SELECT '{value}' AS value, c AS count, {percent}::DOUBLE AS target_percent,
  round(c * 100.0::DOUBLE / n, 2) AS percent, round(abs(c * 100.0::DOUBLE / n - {percent}), 2) AS distance
FROM (SELECT count(*) AS n, count(*) FILTER ({hit}) AS c FROM {relation})"""
            )
    return with_(USERS, CONTENTS) + "\nUNION ALL ".join(lines)


def _schema_sql() -> str:
    lines = []
    found = {
        "user_profiles": ("users", {
            "user_id": "string", "user_segment": "string", "signup_date": "date", "total_purchases": "int",
            "total_spent": "decimal(12,2)", "favorite_categories": "array<string>",
        }),
        "contents": ("contents", {
            "content_id": "string", "title": "string", "content_type": "string", "genre": "string",
            "sub_genre": "string", "duration_minutes": "int", "release_year": "int", "rating": "double",
            "review_count": "int",
        }),
        "recommendations": ("recs", {
            "user_id": "string", "content_id": "string", "created_at": "timestamp_ntz",
            "recommendation_score": "double", "algorithm": "string", "ab_test_group": "string",
        }),
    }
    renamed = {"favorite_categories": "favorites"}
    for table, (relation, columns) in found.items():
        for f in TABLES[table].columns:
            have = columns.get(f.name)
            want = f.dataType.simpleString()
            status = "missing" if have is None else "ok" if want == have else "type"
            kind = f"'{have}'" if have else "NULL"
            filled = f"count({renamed.get(f.name, f.name)})" if have else "count(NULL)"
            lines.append(
                f"SELECT '{table}' AS table_name, '{f.name}' AS column_name, '{want}' AS expected_type, "
                f"{kind} AS found_type, '{status}' AS status, {filled} AS filled FROM {relation}"
            )
    return with_(USERS, CONTENTS, RECS) + "\nUNION ALL ".join(lines)


ORACLE = {
    "upsert_users": with_(USERS, "u AS (SELECT *, CAST(split_part(user_id, '-', 2) AS INTEGER) AS n FROM users)") + """
SELECT user_id, user_segment, CASE WHEN n % 2 = 1 THEN total_purchases + 1000 ELSE total_purchases END AS total_purchases,
  CAST(total_spent AS DOUBLE) AS total_spent FROM u
UNION ALL SELECT user_id || '-new', user_segment, total_purchases, CAST(total_spent AS DOUBLE) FROM u WHERE n % 10 = 0""",
    "upsert_contents": with_(CONTENTS) + """SELECT content_id, title, genre, duration_minutes,
  CASE WHEN genre = 'PROMO' THEN review_count + 1 ELSE review_count END AS review_count FROM contents""",
    "delete_by_key": with_(EV, USERS) + """SELECT session_id, user_id, count(*) AS event_count FROM ev
WHERE user_id NOT IN (SELECT user_id FROM users WHERE user_segment = 'VIP') GROUP BY ALL""",
    "dq_duplicates": with_(EV) + """SELECT user_id, content_id, event_type, count(*) AS copies FROM ev
GROUP BY ALL HAVING count(*) > 1""",
    "dq_unique_event_ids": with_(EV) + "SELECT event_id, count(*) AS copies FROM ev GROUP BY 1 HAVING count(*) > 1",
    "dq_rules": _rules_sql(),
    "dq_distribution": _distribution_sql(),
    "orphan_events": with_(EV, CONTENTS) + """SELECT event_id, content_id FROM ev
WHERE content_id NOT IN (SELECT content_id FROM contents WHERE content_type = 'movie')""",
    "orphan_contents": with_(EV, CONTENTS) + """SELECT content_id, count(*) AS "rows" FROM ev
WHERE content_id NOT IN (SELECT content_id FROM contents WHERE content_type = 'movie') GROUP BY 1""",
    "known_user_events": with_(EV, USERS) + """SELECT event_id, user_id FROM ev
WHERE user_id IN (SELECT user_id FROM users WHERE user_segment = 'VIP')""",
    "schema_verify": _schema_sql(),
    "evolve_add_event_id": with_(EV) + """SELECT user_id, content_id, event_type, watched_minutes,
  sha256('{"content_id":"' || content_id || '","event_type":"' || event_type || '","user_id":"' || user_id ||
         '","watched_minutes":' || watched_minutes || '}') AS event_id FROM ev""",
    "row_defaults": with_(USERS) + """SELECT user_id, CASE WHEN user_segment = 'New' THEN 0 ELSE total_purchases END AS total_purchases,
  CAST(total_spent AS DOUBLE) AS total_spent, TIMESTAMP '2024-02-01' AS created_at, TIMESTAMP '2024-02-01' AS updated_at FROM users""",
}
ORACLE |= {
    "stored_upsert_users": ORACLE["upsert_users"],
    "stored_delete_sessions": ORACLE["delete_by_key"],
    "stored_append_events": with_(EV) + "SELECT event_id, event_type, user_id FROM ev",
}
