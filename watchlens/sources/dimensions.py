"""User and content dimensions out of JSON list files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from watchlens.functions.jsontext import parse_text_list
from watchlens.schemas import S, struct

USER_RECORD = struct(
    user_id=S, user_segment=S, signup_date=S, total_purchases=S, total_spent=S, favorite_categories=S
)
CONTENT_RECORD = struct(
    content_id=S, title=S, content_type=S, genre=S, sub_genre=S,
    duration_minutes=S, release_year=S, rating=S, review_count=S,
)


def _records(spark: SparkSession, path: str, schema: StructType, key: str, one_list: bool) -> DataFrame:
    if one_list:
        # Items are taken apart as text first: one that is no object must not spoil the others.
        items = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "array<string>")).alias("item"))
        records = items.select(F.from_json("item", schema).alias("r")).select("r.*")
    else:
        records = spark.read.schema(schema).json(path)
    return records.where(F.trim(key) != "")


def _require_rows(df: DataFrame, what: str, path: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"no valid {what} in {path}")
    return df


def read_users(spark: SparkSession, path: str, one_list: bool = True) -> DataFrame:
    """Users from a JSON list file, or from JSON lines with `one_list=False`.

    One list file is read as one row; large user sets belong in JSON lines or parquet.
    """
    users = clean_users(_records(spark, path, USER_RECORD, "user_id", one_list))
    return _require_rows(users, "users", path)


def read_contents(spark: SparkSession, path: str, one_list: bool = True) -> DataFrame:
    """Contents from a JSON list file, or from JSON lines with `one_list=False`."""
    contents = clean_contents(_records(spark, path, CONTENT_RECORD, "content_id", one_list))
    return _require_rows(contents, "contents", path)


def clean_users(records: DataFrame) -> DataFrame:
    """Trim ids, drop blank ones, name missing segments `Unknown`, parse the favourites.

    Profile columns, where present, are cast; what does not cast is NULL.
    """
    profile = {"signup_date": "date", "total_purchases": "int", "total_spent": "decimal(12,2)"}
    return records.where(F.trim("user_id") != "").select(
        F.trim("user_id").alias("user_id"),
        F.coalesce(F.nullif(F.trim("user_segment"), F.lit("")), F.lit("Unknown")).alias("user_segment"),
        *[F.col(name).try_cast(kind).alias(name) for name, kind in profile.items() if name in records.columns],
        parse_text_list(F.col("favorite_categories")).alias("favorite_categories"),
    )


def clean_contents(records: DataFrame) -> DataFrame:
    """Trim ids, drop blank ones and rows with an unreadable number; missing numbers are 0."""
    kinds = {"duration_minutes": "int", "release_year": "int", "rating": "double", "review_count": "int"}
    texts = ("title", "content_type", "genre", "sub_genre")
    readable = F.lit(True)
    numbers = []
    for name, kind in kinds.items():
        given = F.coalesce(F.trim(name) != "", F.lit(False))
        value = F.trim(name).try_cast(kind)
        readable = readable & (~given | value.isNotNull())
        numbers.append(F.coalesce(value, F.lit(0).cast(kind)).alias(name))
    return records.where((F.trim("content_id") != "") & readable).select(
        F.trim("content_id").alias("content_id"),
        *[F.coalesce(name, F.lit("")).alias(name) for name in texts],
        *numbers,
    )
