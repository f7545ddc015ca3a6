"""Record shapes, value domains and table definitions."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# The event and content domains and the documented defaults.
EVENT_TYPES = ("click", "watch", "watchlist", "watch_complete", "rating")
CONTENT_TYPES = ("movie", "series", "documentary")
REQUIRED_FIELDS = ("event_id", "timestamp", "user_id", "session_id", "event_type", "content_id")
SEGMENT_TARGETS = {"VIP": 20.0, "Regular": 50.0, "New": 30.0}
CONTENT_TYPE_TARGETS = {"movie": 60.0, "series": 30.0, "documentary": 10.0}
GROUP_ALGORITHMS = {"A": "algorithm_v1", "B": "algorithm_v2"}
SESSION_WINDOW = "3 minutes"
SESSION_WATERMARK = "10 minutes"
SESSION_TRIGGER = "3 seconds"
INGEST_TRIGGER = "5 seconds"
SESSION_GAP_SECONDS = 180
RECOMMENDATION_TTL_SECONDS = 600
RECOMMENDATIONS_PER_USER = 10
INTERACTION_WEIGHTS = {"click": 1, "watchlist": 2, "watch": 3, "rating": 3, "watch_complete": 5}
SEGMENT_WEIGHTS = {"vip": 3.0, "regular": 2.0}
SEGMENT_WEIGHT_OTHER = 1.0


def struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


S, I, L, D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
STRING_MAP = T.MapType(S, S)
STRING_LIST = T.ArrayType(S)

#: What a viewing event looks like once parsed.
USER_EVENT = struct(
    event_id=S, timestamp=S, user_id=S, session_id=S, event_type=S, content_id=S,
    genre=S, duration_minutes=I, watched_minutes=I, metadata=STRING_MAP,
)

#: The same record as read from the wire: numbers stay text so that a badly typed
#: number costs one field, not the record.
WIRE_EVENT = struct(
    event_id=S, timestamp=S, user_id=S, session_id=S, event_type=S, content_id=S,
    genre=S, duration_minutes=S, watched_minutes=S, metadata=STRING_MAP,
)

#: Columns of a message source, as Spark's Kafka source names them.
MESSAGE = struct(
    key=T.BinaryType(), value=T.BinaryType(), topic=S, partition=I, offset=L,
    timestamp=T.TimestampType(),
)


@dataclass(frozen=True)
class TableSpec:
    """Columns, key and rules of one stored table."""

    name: str
    columns: T.StructType
    key: tuple[str, ...]
    required: tuple[str, ...] = ()
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)
    max_length: dict[str, int] = field(default_factory=dict)
    ranges: dict[str, tuple[float, float]] = field(default_factory=dict)
    defaults: dict[str, object] = field(default_factory=dict)
    stamped: tuple[str, ...] = ("created_at",)
    partition_by: tuple[str, ...] = ()


TS = T.TimestampNTZType()
B = T.BooleanType()

TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        TableSpec(
            "user_profiles",
            struct(
                user_id=S, user_segment=S, signup_date=T.DateType(), total_purchases=I,
                total_spent=T.DecimalType(12, 2), favorite_categories=STRING_LIST,
                created_at=TS, updated_at=TS,
            ),
            key=("user_id",),
            required=("user_id",),
            max_length={"user_id": 50, "user_segment": 20},
            defaults={"total_purchases": 0, "total_spent": 0},
            stamped=("created_at", "updated_at"),
        ),
        TableSpec(
            "contents",
            struct(
                content_id=S, title=S, content_type=S, genre=S, sub_genre=S,
                duration_minutes=I, release_year=I, rating=D, review_count=I, created_at=TS,
            ),
            key=("content_id",),
            required=("content_id", "title", "content_type"),
            domains={"content_type": CONTENT_TYPES},
            max_length={"content_id": 50, "title": 255, "genre": 100, "sub_genre": 100},
            ranges={"rating": (1.0, 5.0)},
            defaults={"review_count": 0},
        ),
        TableSpec(
            "user_events",
            struct(
                event_id=S, user_id=S, session_id=S, event_type=S, content_id=S,
                watched_minutes=I, timestamp=TS, metadata=S, created_at=TS, event_date=T.DateType(),
            ),
            key=("event_id",),
            required=("event_id", "user_id", "event_type", "timestamp"),
            domains={"event_type": EVENT_TYPES},
            max_length={"event_id": 100, "user_id": 50, "session_id": 100, "content_id": 50},
            partition_by=("event_date",),
        ),
        TableSpec(
            "user_sessions",
            struct(
                session_id=S, user_id=S, window_start=TS, window_end=TS, start_time=TS, end_time=TS,
                event_count=L, total_watched_minutes=L, browsed_contents=STRING_LIST,
                watched_contents=STRING_LIST, completed_contents=STRING_LIST,
                created_at=TS, updated_at=TS,
            ),
            key=("session_id", "user_id", "window_start"),
            required=("session_id", "user_id", "start_time"),
            max_length={"session_id": 100, "user_id": 50},
            defaults={"event_count": 0, "total_watched_minutes": 0},
            stamped=("created_at", "updated_at"),
        ),
        TableSpec(
            "recommendations",
            struct(
                user_id=S, content_id=S, recommendation_score=D, algorithm=S, ab_test_group=S,
                is_clicked=B, is_watched=B, created_at=TS,
            ),
            key=("user_id", "content_id", "created_at"),
            required=("user_id", "content_id"),
            max_length={"user_id": 50, "content_id": 50, "algorithm": 50, "ab_test_group": 20},
            ranges={"recommendation_score": (0.0, 1.0)},
            defaults={"is_clicked": False, "is_watched": False},
        ),
        TableSpec(
            "ab_test_groups",
            struct(
                group_name=S, description=S, algorithm=S, config=STRING_MAP, is_active=B, created_at=TS,
            ),
            key=("group_name",),
            required=("group_name",),
            max_length={"group_name": 50, "algorithm": 50},
            defaults={"is_active": True},
        ),
        TableSpec(
            "ab_test_metrics",
            struct(
                test_group=S, metric_name=S, metric_value=D, sample_size=L, timestamp=TS, created_at=TS,
            ),
            key=("test_group", "metric_name", "timestamp"),
            required=("test_group", "timestamp"),
            max_length={"test_group": 20, "metric_name": 100},
        ),
        TableSpec(
            "system_metrics",
            struct(metric_name=S, metric_value=D, labels=STRING_MAP, timestamp=TS, created_at=TS),
            key=("metric_name", "timestamp"),
            required=("metric_name", "timestamp"),
            max_length={"metric_name": 100},
        ),
    )
}
