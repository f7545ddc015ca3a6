"""Statistics over events, users and contents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from watchlens.functions.jsontext import metadata_value
from watchlens.functions.weights import segment_weight
from watchlens.plans.ordered import along_time
from watchlens.schemas import EVENT_TYPES


def count_by(df: DataFrame, *keys: str, name: str = "rows") -> DataFrame:
    """Rows per group; the whole table's count without keys."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def shares(df: DataFrame, key: str) -> DataFrame:
    """Rows per value of `key` and their percentage of all rows."""
    total = df.agg(F.count(F.lit(1))).scalar()
    percent = F.round(F.col("rows") * 100.0 / total, 2)
    return count_by(df, key).withColumn("percent", percent)


def user_statistics(users: DataFrame) -> DataFrame:
    """One row: users, mean purchases, mean and total spending, to two decimals."""
    return users.agg(
        F.count(F.lit(1)).alias("total_users"),
        F.round(F.avg("total_purchases"), 2).alias("avg_purchases"),
        F.round(F.avg("total_spent").cast("double"), 2).alias("avg_spent"),
        F.round(F.sum("total_spent").cast("double"), 2).alias("total_spent"),
    )


def content_statistics(contents: DataFrame) -> DataFrame:
    """One row: contents, mean rating to two decimals, mean minutes to one."""
    return contents.agg(
        F.count(F.lit(1)).alias("total_contents"),
        F.round(F.avg("rating"), 2).alias("avg_rating"),
        F.round(F.avg("duration_minutes"), 1).alias("avg_duration"),
    )


def top_genres(contents: DataFrame, limit: int = 5) -> DataFrame:
    """The genres with most contents."""
    return count_by(contents, "genre", name="contents").orderBy(F.desc("contents"), "genre").limit(limit)


def enrich(events: DataFrame, users: DataFrame, contents: DataFrame) -> DataFrame:
    """Events with their user's segment and their content's attributes; unknown ones stay, with NULLs.

    No broadcast is forced: Spark broadcasts a dimension when its measured size
    allows, and otherwise splits hot users or contents at run time.
    """
    user = users.select("user_id", "user_segment")
    content = contents.select("content_id", "title", "genre", "sub_genre", "content_type", "duration_minutes")
    return events.join(content, "content_id", "left").join(user, "user_id", "left")


def event_transitions(events: DataFrame) -> DataFrame:
    """How often each event type follows another within a user, and with which probability."""
    slim = events.select("user_id", "event_id", "timestamp_ts", "event_type")
    follow = along_time(
        slim, ["user_id"], ["timestamp_ts", "event_id"], previous={"previous_type": F.col("event_type")}
    ).where(F.col("previous_type").isNotNull())
    counts = follow.groupBy("previous_type", "event_type").agg(F.count(F.lit(1)).alias("transitions"))
    # Counts are one row per pair of types.
    total = F.sum("transitions").over(Window.partitionBy("previous_type"))
    return counts.withColumn("probability", F.round(F.col("transitions") / total, 6))


def segment_weighted(events: DataFrame, users: DataFrame) -> DataFrame:
    """Mean watched minutes with every user's events weighted by segment, one row.

    Events shrink to one row per user before the segments are joined.
    """
    per_user = events.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("events"), F.sum("watched_minutes").alias("minutes")
    )
    weight = segment_weight(F.col("user_segment"))
    weighted = per_user.join(users.select("user_id", "user_segment"), "user_id", "left").withColumn("weight", weight)
    return weighted.agg(
        F.sum("events").alias("events"),
        (F.sum(F.col("weight") * F.col("minutes")) / F.sum(F.col("weight") * F.col("events"))).alias("weighted_minutes"),
    )


def events_by_type(events: DataFrame) -> DataFrame:
    """Per user, one count column per event type."""
    return events.groupBy("user_id").agg(
        *[F.count_if(F.col("event_type") == kind).alias(f"{kind}_events") for kind in EVENT_TYPES],
        F.count(F.lit(1)).alias("events"),
    )


def genre_hour_cube(events: DataFrame, contents: DataFrame) -> DataFrame:
    """Events and minutes by genre and hour of day with all subtotals.

    Events shrink to (content, hour) before genres are joined, and to
    (genre, hour) before the cube multiplies rows.
    """
    hourly = events.groupBy("content_id", F.hour("timestamp_ts").alias("hour")).agg(
        F.count(F.lit(1)).alias("events"), F.sum("watched_minutes").alias("minutes")
    )
    base = (
        hourly.join(contents.select("content_id", "genre"), "content_id", "left")
        .groupBy(F.coalesce("genre", F.lit("Unknown")).alias("genre"), "hour")
        .agg(F.sum("events").alias("events"), F.sum("minutes").alias("minutes"))
    )
    return base.cube("genre", "hour").agg(
        F.sum("events").alias("events"),
        F.sum("minutes").alias("minutes"),
        F.grouping_id().cast("int").alias("level"),
    )


def heat_map(events: DataFrame, bucket: str = "1 hour", approximate: bool | None = None) -> DataFrame:
    """Views, distinct viewers and minutes per content and time bucket, over watch events.

    Streams count viewers approximately, as exact distinct counts need unbounded state.
    """
    if approximate is None:
        approximate = events.isStreaming
    viewers = F.approx_count_distinct("user_id") if approximate else F.count_distinct("user_id")
    watched = events.where(F.col("event_type").isin("watch", "watch_complete"))
    spans = F.window("timestamp_ts", bucket)
    return (
        watched.groupBy("content_id", spans)
        .agg(
            F.count(F.lit(1)).alias("views"),
            viewers.alias("viewers"),
            F.sum("watched_minutes").alias("minutes"),
        )
        .select("content_id", F.col("window.start").alias("bucket_start"), "views", "viewers", "minutes")
    )


def viewer_sketches(events: DataFrame, bucket: str = "1 hour", precision: int = 14) -> DataFrame:
    """Views, minutes and a sketch of the viewers per content and time bucket, over watch events.

    Sketches merge to those of longer times, of many contents, or of a batch and a stream, see `merged_viewers`. With 2^14
    registers the standard error of a count is 0.8 %.
    """
    watched = events.where(F.col("event_type").isin("watch", "watch_complete"))
    return (
        watched.groupBy("content_id", F.window("timestamp_ts", bucket))
        .agg(
            F.count(F.lit(1)).alias("views"),
            F.sum("watched_minutes").alias("minutes"),
            F.hll_sketch_agg("user_id", precision).alias("viewers"),
        )
        .select("content_id", F.col("window.start").alias("bucket_start"), "views", "minutes", "viewers")
    )


def merged_viewers(sketches: DataFrame, unit: str = "day", keys: tuple[str, ...] = ("content_id",)) -> DataFrame:
    """Views, minutes and viewers per `keys` and longer time (a `date_trunc` unit), from stored sketches alone."""
    return sketches.groupBy(*keys, F.date_trunc(unit, "bucket_start").cast(sketches.schema["bucket_start"].dataType).alias("bucket_start")).agg(
        F.sum("views").alias("views"), F.sum("minutes").alias("minutes"), F.hll_sketch_estimate(F.hll_union_agg("viewers")).alias("viewers")
    )


def hash_sample(rows: DataFrame, n: int, id_column: str, keys: list[str] | None = None) -> DataFrame:
    """The `n` rows (of each key) whose ids have the smallest SHA-256: a fair sample of distinct ids, the same on every run.

    The sample of several parts is the sample of their samples, so batches of a stream merge. It is a rank filter,
    which Spark applies in every task before it shuffles. `place` counts from 1.
    """
    order = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(F.sha2(F.col(id_column).cast("string"), 256), id_column)
    return rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)


def activity(events: DataFrame, key: str, bucket: str = "1 hour") -> DataFrame:
    """Events per value of `key` and time bucket."""
    return (
        events.groupBy(key, F.window("timestamp_ts", bucket))
        .agg(F.count(F.lit(1)).alias("events"))
        .select(key, F.col("window.start").alias("bucket_start"), "events")
    )


def moving_average(series: DataFrame, key: str, buckets: int = 3) -> DataFrame:
    """Mean of `events` over this and the preceding buckets of a key, `buckets` in all."""
    # A series has one row per key and time bucket, however many events went in.
    recent = Window.partitionBy(key).orderBy("bucket_start").rowsBetween(1 - buckets, 0)
    return series.withColumn("moving_average", F.avg("events").over(recent))


def genre_preference(events: DataFrame, contents: DataFrame) -> DataFrame:
    """Each user's events and minutes by genre, and each genre's share of the user's events.

    Events of contents that the catalogue does not have are of genre `Unknown`.
    """
    per_content = events.groupBy("user_id", "content_id").agg(
        F.count(F.lit(1)).alias("events"), F.sum("watched_minutes").alias("minutes")
    )
    genres = contents.select("content_id", "genre")
    known = per_content.join(genres, "content_id", "left").withColumn("genre", F.coalesce("genre", F.lit("Unknown")))
    per_genre = known.groupBy("user_id", "genre").agg(
        F.sum("events").alias("events"), F.sum("minutes").alias("minutes")
    )
    # At most one row per genre in a user's window.
    total = F.sum("events").over(Window.partitionBy("user_id"))
    return per_genre.withColumn("share", F.round(F.col("events") / total, 6))


def drop_off(events: DataFrame, contents: DataFrame) -> DataFrame:
    """Watch events per content and tenth of its length where watching stopped.

    Bucket 10 holds watches of the whole length or more. Contents without a
    length, or unknown to the catalogue, have their watches under a NULL tenth. Events shrink to distinct minutes before the join.
    """
    watched = events.where(F.col("event_type") == "watch").groupBy("content_id", "watched_minutes").agg(
        F.count(F.lit(1)).alias("watches")
    )
    lengths = contents.where("duration_minutes > 0").select("content_id", "duration_minutes")
    joined = watched.join(lengths, "content_id", "left")
    tenth = F.when(
        F.col("duration_minutes").isNotNull(),
        F.least(F.floor(F.col("watched_minutes") * 10 / F.col("duration_minutes")), F.lit(10)),
    ).cast("int")
    ratio = F.when(
        F.col("duration_minutes").isNotNull(), F.least(F.col("watched_minutes") / F.col("duration_minutes"), F.lit(1.0))
    )
    return joined.groupBy("content_id", tenth.alias("tenth")).agg(
        F.sum("watches").alias("watches"),
        F.round(F.sum(ratio * F.col("watches")) / F.sum("watches"), 6).alias("mean_ratio"),
    )


def rating_summary(events: DataFrame) -> DataFrame:
    """Ratings per content: number, mean and counts of 1 to 5."""
    rating = metadata_value(F.col("metadata"), "rating").try_cast("int")
    rated = events.where(F.col("event_type") == "rating").select("content_id", rating.alias("rating"))
    valid = rated.where(F.col("rating").between(1, 5))
    return valid.groupBy("content_id").agg(
        F.count(F.lit(1)).alias("ratings"),
        F.round(F.avg("rating"), 6).alias("mean_rating"),
        *[F.count_if(F.col("rating") == value).alias(f"rated_{value}") for value in range(1, 6)],
    )


def rewatches(events: DataFrame) -> DataFrame:
    """Watch and watch-complete events, marked when the user had watched the content before."""
    watched = events.where(F.col("event_type").isin("watch", "watch_complete"))
    numbered = along_time(
        watched, ["user_id", "content_id"], ["timestamp_ts", "event_id"], running={"viewing": F.lit(1)}
    )
    return numbered.withColumn("is_rewatch", F.col("viewing") > 1)


def current_watchlist(events: DataFrame) -> DataFrame:
    """(user, content) pairs whose latest watchlist action is `add`."""
    actions = events.where(F.col("event_type") == "watchlist").select(
        "user_id", "content_id", "timestamp_ts", "event_id",
        metadata_value(F.col("metadata"), "action").alias("action"),
    )
    latest = actions.groupBy("user_id", "content_id").agg(
        F.max(F.struct("timestamp_ts", "event_id", "action")).alias("last")
    )
    return latest.where(F.col("last.action") == "add").select(
        "user_id", "content_id", F.col("last.timestamp_ts").alias("added_at")
    )


def user_card(users: DataFrame, events: DataFrame) -> DataFrame:
    """User profiles with their activity totals; users without events have zeros."""
    totals = events.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.sum("watched_minutes").alias("watched_minutes"),
        F.max("timestamp_ts").alias("last_seen"),
    )
    zero = F.lit(0)
    return users.join(totals, "user_id", "left").withColumns(
        {"events": F.coalesce("events", zero), "watched_minutes": F.coalesce("watched_minutes", zero)}
    )


def watch_history(events: DataFrame, day: Column | None = None) -> DataFrame:
    """Per user and day: watches, completions and minutes of both."""
    day = F.to_date("timestamp_ts") if day is None else day
    watched = events.where(F.col("event_type").isin("watch", "watch_complete"))
    return watched.groupBy("user_id", day.alias("day")).agg(
        F.count_if(F.col("event_type") == "watch").alias("watches"),
        F.count_if(F.col("event_type") == "watch_complete").alias("completions"),
        F.sum("watched_minutes").alias("minutes"),
    )
