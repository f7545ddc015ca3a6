"""The engine's tables, read out of the star-schema parquet tables used for checks.

One function per engine table. `folder` holds `<table>.parquet` files or directories.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from watchlens.functions.identity import ab_group, prefixed_id
from watchlens.functions.times import utc_instant

# How the check tables' codes read in this domain.
EVENT_TYPE_OF = {
    "click": "click", "view": "watch", "purchase": "watch_complete", "signup": "watchlist", "error": "rating",
}
SEGMENT_OF = {"BUILDING": "VIP", "FURNITURE": "Regular", "MACHINERY": "Regular", "AUTOMOBILE": "New", "HOUSEHOLD": "New"}
CONTENT_TYPE_OF = {
    "ECONOMY": "movie", "SMALL": "movie", "MEDIUM": "movie",
    "PROMO": "series", "STANDARD": "series", "LARGE": "documentary",
}
FAVORITE_GENRES = ("ECONOMY", "SMALL", "MEDIUM", "PROMO", "STANDARD", "LARGE")

EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _mapped(code: Column, mapping: dict[str, str], other: Column) -> Column:
    result = other
    for source, target in mapping.items():
        result = F.when(code == source, target).otherwise(result)
    return result


def as_user_events(events: DataFrame) -> DataFrame:
    """Check-table events as `user_events`; works on batch and streaming frames."""
    k = F.get_json_object("props", "$.k").cast("int")
    user = prefixed_id("user", F.col("user_id"))
    kind = _mapped(F.col("event_type"), EVENT_TYPE_OF, F.col("event_type"))
    plain = events.select(
        F.concat(F.lit("evt-"), F.col("event_id").cast("string")).alias("event_id"),
        user.alias("user_id"),
        F.concat(user, F.lit("-sess-"), F.date_format("ts", "yyyyMMdd")).alias("session_id"),
        kind.alias("event_type"),
        F.concat(F.lit("content-"), k.cast("string")).alias("content_id"),
        F.floor("value").cast("int").alias("watched_minutes"),
        F.col("ts").alias("timestamp_ts"),
        k.alias("k"),
    )
    device = F.when(F.col("k") % 3 == 0, "mobile").when(F.col("k") % 3 == 1, "web").otherwise("tv")
    common = F.create_map(
        F.lit("k"), F.col("k").cast("string"),
        F.lit("ab_test_group"), ab_group(F.col("user_id")),
        F.lit("device"), device,
    )
    rating = F.create_map(F.lit("rating"), (F.col("k") % 5 + 1).cast("string"))
    action = F.create_map(F.lit("action"), F.when(F.col("k") % 2 == 0, "add").otherwise("remove"))
    metadata = (
        F.when(F.col("event_type") == "rating", F.map_concat(common, rating))
        .when(F.col("event_type") == "watchlist", F.map_concat(common, action))
        .otherwise(common)
    )
    return plain.withColumn("metadata", metadata).drop("k")


def user_events(spark: SparkSession, folder: str) -> DataFrame:
    return as_user_events(table(spark, folder, "events"))


def user_profiles(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    genres = F.array(*[F.lit(g) for g in FAVORITE_GENRES])
    first = (key % 6 + 1).cast("int")
    second = ((key * 5 + 2) % 6 + 1).cast("int")
    return table(spark, folder, "customer").select(
        prefixed_id("user", key).alias("user_id"),
        _mapped(F.col("c_mktsegment"), SEGMENT_OF, F.col("c_mktsegment")).alias("user_segment"),
        (F.date_add(F.lit("2020-01-01").cast("date"), (key % 2000).cast("int"))).alias("signup_date"),
        (key % 100).cast("int").alias("total_purchases"),
        F.col("c_acctbal").cast("decimal(12,2)").alias("total_spent"),
        F.array_distinct(F.array(F.get(genres, first - 1), F.get(genres, second - 1))).alias("favorite_categories"),
    )


def contents(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, folder, "part").select(
        F.concat(F.lit("content-"), key.cast("string")).alias("content_id"),
        F.col("p_name").alias("title"),
        _mapped(F.col("p_type"), CONTENT_TYPE_OF, F.col("p_type")).alias("content_type"),
        F.col("p_type").alias("genre"),
        F.col("p_brand").alias("sub_genre"),
        F.col("p_size").alias("duration_minutes"),
        (key % 36 + 1990).cast("int").alias("release_year"),
        (F.col("p_retailprice") % 5 * 0.8 + 1).alias("rating"),
        (key * 37 % 50000).cast("int").alias("review_count"),
    )


def without_some(contents: DataFrame) -> DataFrame:
    """A catalogue that lacks every seventh content, so that events and lists hold unknown ones."""
    return contents.where(F.substring_index("content_id", "-", -1).cast("int") % 7 != 0)


def recommendations(spark: SparkSession, folder: str) -> DataFrame:
    """Stored recommendations, one per (user, content, hour of creation), out of the order lines."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    user = prefixed_id("user", F.col("o_custkey"))
    hour = F.make_dt_interval(hours=(F.col("l_orderkey") % 600).cast("int"))
    picked = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        user.alias("user_id"),
        F.concat(F.lit("content-"), (F.col("l_partkey") % 100).cast("string")).alias("content_id"),
        (F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'") + hour).alias("created_at"),
        (F.col("l_quantity") / 50).alias("recommendation_score"),
    )
    collaborative = F.col("ab_test_group") == "A"
    return (
        picked.groupBy("user_id", "content_id", "created_at")
        .agg(F.max("recommendation_score").alias("recommendation_score"))
        .withColumn("ab_test_group", ab_group(F.col("user_id")))
        .withColumn("algorithm", F.when(collaborative, "collaborative_filtering").otherwise("session_based"))
    )


def as_messages(events: DataFrame) -> DataFrame:
    """Events as raw messages, one in twenty of each kind of damage the ingest must sort out.

    Damage follows `event_id % 20`; number 8 is delivered twice.
    """
    case = F.col("__id") % 20
    typed = as_user_events(events.withColumn("__id", F.col("event_id")))
    # as_user_events selects its own columns, so the number is taken from the id.
    typed = typed.withColumn("__id", F.substring_index("event_id", "-", -1).cast("bigint"))
    wall = F.col("timestamp_ts")
    stamp = (
        F.when(case == 9, "not-a-time")
        .when(case == 10, F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(case == 11, F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"))
        .when(case == 12, F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .otherwise(F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    )
    body = F.to_json(
        F.struct(
            "event_id",
            stamp.alias("timestamp"),
            F.when(case != 1, F.col("user_id")).alias("user_id"),
            "session_id",
            F.when(case == 2, "paused").otherwise(F.col("event_type")).alias("event_type"),
            F.when(case == 3, "").otherwise(F.col("content_id")).alias("content_id"),
            "watched_minutes",
            "metadata",
        )
    )
    value = (
        F.when(case == 0, F.concat(F.lit("!"), body))
        .when(case == 4, "null")
        .when(case == 5, F.concat(F.lit("["), body, F.lit("]")))
        .when(case == 6, "42")
        .when(case == 7, "{}")
        .otherwise(body)
    )
    copies = F.when(case == 8, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        typed.withColumn("value", F.encode(value, "UTF-8"))
        .withColumn("__copy", F.explode(copies))
        .select(
            F.encode("user_id", "UTF-8").alias("key"),
            "value",
            F.lit("user-events").alias("topic"),
            (F.col("__id") % 3).cast("int").alias("partition"),
            (F.col("__id") * 2 + F.col("__copy")).alias("offset"),
            utc_instant(wall).alias("timestamp"),
        )
    )


def messages(spark: SparkSession, folder: str) -> DataFrame:
    return as_messages(table(spark, folder, "events"))
