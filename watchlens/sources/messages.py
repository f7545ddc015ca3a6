"""Message sources: Kafka, and files with the same columns. Streams and bounded reads.

All give `key, value, topic, partition, offset, timestamp`, as Spark's Kafka source does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from watchlens.schemas import MESSAGE

_COLUMNS = MESSAGE.fieldNames()


def kafka_options(servers: str, topic: str, starting_offsets: str | None = None) -> dict[str, str]:
    """Options of the Kafka source. Needs Spark's Kafka connector on the class path.

    Offsets live in the query's checkpoint, which wins over `startingOffsets`
    once it exists; so a new query reads from the start and a restarted one goes on.
    """
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets or "earliest",
    }


def kafka_stream(
    spark: SparkSession, servers: str, topic: str, starting_offsets: str | None = None,
    max_per_trigger: int | None = None, options: dict[str, str] | None = None,
) -> DataFrame:
    """A topic as a stream. `max_per_trigger` bounds a micro-batch."""
    reader = spark.readStream.format("kafka").options(**kafka_options(servers, topic, starting_offsets))
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.options(**(options or {})).load().select(*_COLUMNS)


def kafka_batch(
    spark: SparkSession, servers: str, topic: str, starting_offsets: str = "earliest",
    ending_offsets: str = "latest", options: dict[str, str] | None = None,
) -> DataFrame:
    """What a topic holds now, for backfills."""
    reader = spark.read.format("kafka").options(**kafka_options(servers, topic, starting_offsets))
    return reader.option("endingOffsets", ending_offsets).options(**(options or {})).load().select(*_COLUMNS)


def stream_path(path: str) -> str:
    """A path the file stream accepts whether it names one file or a folder of files."""
    return path if any(c in path for c in "*?[{") else f"{path[:-1]}[{path[-1]}]"


def file_stream(
    spark: SparkSession, path: str, schema=MESSAGE, file_format: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Files of a folder, or one file, as a stream, in the order they were written."""
    reader = spark.readStream.schema(schema).format(file_format)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(stream_path(path))


def _lines_as_messages(lines: DataFrame, topic: str) -> DataFrame:
    return lines.select(
        F.lit(None).cast("binary").alias("key"),
        F.encode("value", "UTF-8").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(None).cast("int").alias("partition"),
        F.lit(None).cast("bigint").alias("offset"),
        F.col("_metadata.file_modification_time").alias("timestamp"),
    )


def json_lines(spark: SparkSession, path: str, topic: str = "file") -> DataFrame:
    """Text files of one JSON event per line, as messages."""
    return _lines_as_messages(spark.read.text(path), topic)


def json_lines_stream(
    spark: SparkSession, path: str, topic: str = "file", max_files_per_trigger: int | None = None
) -> DataFrame:
    """The same as a stream of files."""
    return _lines_as_messages(file_stream(spark, path, "value string", "text", max_files_per_trigger), topic)
