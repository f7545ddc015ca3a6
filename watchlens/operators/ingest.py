"""From raw messages to accepted events and dead letters.

Every function takes and returns a DataFrame and, unless it says otherwise,
works on batch and streaming frames alike.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from watchlens.functions.identity import ab_group
from watchlens.functions.jsontext import metadata_json, metadata_value
from watchlens.functions.times import parse_iso, utc_wall_clock
from watchlens.schemas import EVENT_TYPES, REQUIRED_FIELDS, USER_EVENT, WIRE_EVENT

_ENVELOPE = ("key", "topic", "partition", "offset")
_CORRUPT = "__corrupt"


def decode_events(messages: DataFrame) -> DataFrame:
    """Message values decoded to events, nothing checked: unreadable ones give NULL fields."""
    data = F.from_json(F.col("value").cast("string"), USER_EVENT)
    return messages.select(data.alias("data")).select("data.*")


def add_event_time(events: DataFrame, column: str = "timestamp_ts") -> DataFrame:
    """Add the parsed event instant; NULL where the text is no timestamp."""
    return events.withColumn(column, parse_iso(F.col("timestamp")))


def parse_messages(messages: DataFrame) -> DataFrame:
    """Messages with their fields, event time and `reject_reason` (NULL when accepted).

    Reasons, first match wins: `bad_json`, `not_object`, `missing:<fields>`,
    `bad_event_type`, `bad_timestamp`. An empty required field counts as missing.
    """
    text = F.col("value").cast("string")
    fields = T.StructType([*WIRE_EVENT.fields, T.StructField(_CORRUPT, T.StringType())])
    data = F.from_json(text, fields, {"columnNameOfCorruptRecord": _CORRUPT})
    kept = [name for name in (*_ENVELOPE, "timestamp") if name in messages.columns]
    parsed = messages.select(
        *[F.col(name).alias("message_timestamp" if name == "timestamp" else name) for name in kept],
        text.alias("raw_value"),
        _evaluated_once(data, "data"),
    )
    numbers = ("duration_minutes", "watched_minutes")
    flat = parsed.select(
        *[name for name in parsed.columns if name != "data"],
        *[
            F.col(f"data.{name}").try_cast("int").alias(name) if name in numbers else F.col(f"data.{name}")
            for name in WIRE_EVENT.fieldNames()
        ],
        F.col(f"data.{_CORRUPT}").alias(_CORRUPT),
    )
    timed = flat.withColumn("timestamp_ts", parse_iso(F.col("timestamp")))
    return timed.withColumn("reject_reason", _reject_reason()).drop(_CORRUPT)


def _evaluated_once(value: Column, name: str) -> Column:
    """A column that filters further up refer to instead of repeating its expression.

    Spark pushes filters below projections by copying the expressions they use,
    which would parse the text again for every field a filter looks at. It does
    not push them below a generator.
    """
    return F.explode(F.array(value)).alias(name)


def _missing(name: str) -> Column:
    return ~F.coalesce(F.length(name) > 0, F.lit(False))


def _reject_reason() -> Column:
    raw = F.col("raw_value")
    absent = [_missing(name) for name in REQUIRED_FIELDS]
    names = F.concat_ws(",", *[F.when(gone, name) for gone, name in zip(absent, REQUIRED_FIELDS)])
    return (
        # The second parse runs only for records the first one could not read.
        F.when(F.coalesce(F.trim(raw) == "", F.lit(True)), "bad_json")
        .when(F.col(_CORRUPT).isNotNull() & F.try_parse_json(raw).isNull(), "bad_json")
        .when(~F.ltrim(raw).startswith("{"), "not_object")
        # The reader stops at the closing brace; text after it makes the record bad.
        .when(~F.rtrim(raw).endswith("}"), "bad_json")
        .when(F.col(_CORRUPT).isNotNull() & F.col("event_id").isNull(), "bad_json")
        .when(reduce(or_, absent), F.concat(F.lit("missing:"), names))
        .when(~F.col("event_type").isin(*EVENT_TYPES), "bad_event_type")
        .when(F.col("timestamp_ts").isNull(), "bad_timestamp")
    )


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reject_reason").isNull())


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reject_reason").isNotNull())


def use_now_for_bad_time(parsed: DataFrame) -> DataFrame:
    """Lenient timestamp policy: accept unreadable event times as the current time."""
    bad = F.col("reject_reason") == "bad_timestamp"
    return parsed.withColumn(
        "timestamp_ts", F.coalesce("timestamp_ts", F.current_timestamp())
    ).withColumn("reject_reason", F.when(bad, F.lit(None)).otherwise(F.col("reject_reason")))


def dead_letters(parsed: DataFrame, at: Column | None = None) -> DataFrame:
    """Rejected messages as dead-letter entries, with the whole payload, so that they can be sent again."""
    return rejected(parsed).select(
        (F.current_timestamp() if at is None else at).alias("timestamp"),
        F.lit("MessageProcessingError").alias("error_type"),
        F.col("reject_reason").alias("error_message"),
        "topic",
        "partition",
        "offset",
        F.col("key").cast("string").alias("key"),
        "raw_value",
    )


def failed_saves(events: DataFrame, error: str, at: Column | None = None) -> DataFrame:
    """Accepted events whose save failed, as dead-letter entries."""
    return events.select(
        (F.current_timestamp() if at is None else at).alias("timestamp"),
        F.lit("MySQLSaveError").alias("error_type"),
        F.lit(error).alias("error_message"),
        F.to_json(F.struct(*events.columns)).alias("event"),
    )


def ingest_counts(parsed: DataFrame) -> DataFrame:
    """One row: messages consumed, events saved, rejects."""
    return parsed.agg(
        F.count(F.lit(1)).alias("consumed"),
        F.count_if(F.col("reject_reason").isNull()).alias("saved"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("errors"),
    )


def reason_counts(parsed: DataFrame) -> DataFrame:
    """Messages per outcome."""
    return parsed.groupBy(F.coalesce("reject_reason", F.lit("accepted")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("messages")
    )


def first_per_event(events: DataFrame, order: list[str]) -> DataFrame:
    """One row per event id, the first in `order` (batch only).

    The rank filter is applied before the shuffle too, so a much repeated id
    ships one row per task.
    """
    rank = F.row_number().over(Window.partitionBy("event_id").orderBy(*order))
    return events.withColumn("__rank", rank).where(F.col("__rank") == 1).drop("__rank")


def not_yet_stored(events: DataFrame, stored: DataFrame) -> DataFrame:
    """Events whose id the target table does not hold yet."""
    return events.join(stored.select("event_id"), "event_id", "left_anti")


def stored_event(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Project events to the stored columns, with their defaults, and to the columns of `keep` that are there.

    Events without an id are skipped; missing texts become empty, missing minutes 0.
    """
    texts = ("user_id", "session_id", "event_type", "content_id")
    wall = F.col("timestamp_ts")
    if dict(events.dtypes)["timestamp_ts"] == "timestamp":
        wall = utc_wall_clock(wall)
    return events.where(~_missing("event_id")).select(
        "event_id",
        *[F.coalesce(name, F.lit("")).alias(name) for name in texts],
        F.coalesce("watched_minutes", F.lit(0)).alias("watched_minutes"),
        wall.alias("timestamp"),
        metadata_json(F.col("metadata")).alias("metadata"),
        F.to_date(wall).alias("event_date"),
        *[name for name in keep if name in events.columns],
    )


def semantic_violations(events: DataFrame) -> DataFrame:
    """Count, per rule, the events that contradict their own type.

    Needs `duration_minutes`. One pass, one row per rule.
    """
    kind, watched, duration = F.col("event_type"), F.col("watched_minutes"), F.col("duration_minutes")
    rating = metadata_value(F.col("metadata"), "rating").try_cast("int")
    label = metadata_value(F.col("metadata"), "ab_test_group")
    rules = {
        "click_has_minutes": (kind == "click") & (watched != 0),
        "watchlist_has_minutes": (kind == "watchlist") & (watched != 0),
        "watch_out_of_range": (kind == "watch") & (duration > 0) & ~watched.between(1, duration),
        "complete_not_full": (kind == "watch_complete") & (watched != duration),
        "rating_out_of_range": (kind == "rating") & ~F.coalesce(rating.between(1, 5), F.lit(False)),
        "ab_label_wrong": F.coalesce(label != ab_group(F.col("user_id")), F.lit(True)),
    }
    counts = events.agg(*[F.count_if(F.coalesce(broken, F.lit(False))).alias(name) for name, broken in rules.items()])
    return counts.unpivot([], list(rules), "rule", "violations")

