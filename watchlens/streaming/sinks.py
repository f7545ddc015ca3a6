"""Streaming sinks that can be repeated without harm.

A failed or restarted query runs its last batch again. Each batch therefore
writes only a folder of its own, `batch_id=<n>`, in overwrite mode. A sink never
swallows an error: the batch must fail so that the checkpoint does not pass it.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from watchlens.operators.ingest import accepted, dead_letters, failed_saves, first_per_event, ingest_counts, stored_event
from watchlens.operators.sessions import as_table_row
from watchlens.operators.stats import hash_sample
from watchlens.operators.stored import append_new
from watchlens.operators.tables import last_per_key
from watchlens.session import remove_folder, sub_folders
from watchlens.sources.relational import replace_jdbc

#: Events of a batch that are kept to look at.
SAMPLE_ROWS = 5
SESSION_KEY = ["session_id", "user_id", "window_start"]
#: Where and when a message arrived; the first arrival of an event counts.
ARRIVAL = ("message_timestamp", "topic", "partition", "offset")


def with_retries(
    write: Callable[[], None], attempts: int = 3, first_pause: float = 1.0,
    on_failure: Callable[[Exception], None] | None = None, sleep: Callable[[float], None] = time.sleep,
) -> None:
    """Run a write up to `attempts` times, pausing twice as long each time, then raise its error."""
    for attempt in range(attempts):
        try:
            return write()
        except Exception as error:
            if on_failure:
                on_failure(error)
            if attempt == attempts - 1:
                raise
            sleep(first_pause * 2**attempt)


def write_batch(df: DataFrame, path: str, batch_id: int, partition_by: tuple[str, ...] = ()) -> None:
    """Write one batch into its own folder; a repeat replaces it.

    Rows of a partition value are brought together for few files, and a value
    that holds many is split again.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path}/batch_id={batch_id}")


def batch_log(path: str) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` function that logs every batch, with retries."""
    return lambda df, batch_id: with_retries(lambda: write_batch(df, path, batch_id))


def session_jdbc_writer(
    url: str, table: str = "user_sessions", properties: dict[str, str] | None = None, connections: int = 16,
    staging: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` function that puts session windows into a relational table at its key.

    A batch replaces the staging table (a query needs one of its own), then moves over in one transaction: rows of its keys are
    deleted and put in again. Repeating a batch therefore changes nothing, and a window that comes
    out again in `update` mode replaces its earlier row.
    """
    return lambda df, batch_id: with_retries(
        lambda: replace_jdbc(as_table_row(df), url, table, SESSION_KEY, staging or f"{table}_staging", properties, connections)
    )


def _read_if_any(spark: SparkSession, path: str) -> DataFrame | None:
    """A Parquet folder, or None where there is none or nothing in it."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _folded(spark: SparkSession, snapshot: str | None) -> tuple[DataFrame | None, int]:
    """The rows of the newest complete snapshot and the last batch in them."""
    done = _read_if_any(spark, f"{snapshot}/done") if snapshot else None
    if done is None:
        return None, -1
    upto = done.agg(F.max("upto")).first()[0]
    return spark.read.parquet(f"{snapshot}/rows/upto={upto}"), upto


def current_rows(spark: SparkSession, path: str, key: list[str], snapshot: str | None = None) -> DataFrame:
    """The latest row of each key out of a batch log.

    In update mode a key's later row replaces its earlier ones, so the last
    batch wins. With a snapshot, only later batches are read from the log, and
    there need be none.
    """
    folded, upto = _folded(spark, snapshot)
    log = spark.read.parquet(path) if folded is None else _read_if_any(spark, path)
    if folded is None:
        return last_per_key(log, key, ["batch_id"]).drop("batch_id")
    if log is None:
        return folded
    newer = log.where(F.col("batch_id") > upto).unionByName(folded.withColumn("batch_id", F.lit(upto)))
    return last_per_key(newer, key, ["batch_id"]).drop("batch_id")


def write_snapshot(spark: SparkSession, path: str, key: list[str], out: str) -> None:
    """Fold the snapshot at `out` and the newer batches of a log into the next snapshot there.

    Every snapshot has a folder of its own and counts from when its number is added to `done`, so
    readers of the one before are not disturbed. Log folders up to the last batch folded, and
    older snapshots, may be deleted afterwards. Without newer batches nothing is written.
    """
    _, upto = _folded(spark, out)
    log = _read_if_any(spark, path)
    last = log.agg(F.max("batch_id")).first()[0] if log is not None else None
    if last is None or last <= upto:
        return
    current_rows(spark, path, key, out).write.mode("overwrite").parquet(f"{out}/rows/upto={last}")
    spark.range(1).select(F.lit(int(last)).cast("long").alias("upto")).write.mode("append").parquet(f"{out}/done")


def retire_batches(spark: SparkSession, path: str, out: str) -> int:
    """Delete the log folders that the newest snapshot at `out` holds, and older snapshots; gives the folders deleted.

    Readers must go by the newest snapshot by then. What came after it stays, so this may run beside the query that writes the log.
    """
    _, upto = _folded(spark, out)
    gone = 0
    for folder, name, least in ((path, "batch_id", upto), (f"{out}/rows", "upto", upto - 1)):
        for number in sub_folders(spark, folder, name):
            if number <= least:
                gone += remove_folder(spark, f"{folder}/{name}={number}")
    return gone


def current_events(spark: SparkSession, path: str) -> DataFrame:
    """Stored raw events once each: of an event's copies the one that arrived first."""
    log = spark.read.parquet(path)
    order = [name for name in (*ARRIVAL, "batch_id") if name in log.columns]
    rest = [name for name in log.columns if name not in order]
    return first_per_event(log, [*order, *rest]).drop(*order)


def current_sessions(spark: SparkSession, path: str, snapshot: str | None = None) -> DataFrame:
    return current_rows(spark, path, SESSION_KEY, snapshot)


def new_events_writer(path: str, on_failure: Callable[[Exception], None] | None = None) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` function that adds a batch's accepted events to a stored table, each event id once.

    Ids are looked up in the table by its filters, so stored events are hardly read. A repeated batch adds nothing.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        events = stored_event(accepted(batch), ARRIVAL)
        order = [name for name in ARRIVAL if name in events.columns]
        with_retries(lambda: append_new(batch.sparkSession, path, events, order or None), on_failure=on_failure)

    return write


def ingest_writer(
    events_path: str, letters_path: str, on_failure: Callable[[Exception], None] | None = None,
    counts_path: str | None = None, failed_path: str | None = None, samples_path: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` function that stores accepted events by date and rejects as dead letters.

    The batch is kept while both are written, so its source is read once. If the events cannot be
    stored, they go to `failed_path` as dead letters and the batch fails. `samples_path` gets `SAMPLE_ROWS` events of each
    batch, see `stats.hash_sample`; a repeated batch gives the same ones.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            events = stored_event(accepted(kept), ARRIVAL)
            try:
                with_retries(lambda: write_batch(events, events_path, batch_id, ("event_date",)), on_failure=on_failure)
            except Exception as error:
                if failed_path:
                    write_batch(failed_saves(events, str(error)), failed_path, batch_id)
                raise
            letters = dead_letters(kept)
            with_retries(lambda: write_batch(letters, letters_path, batch_id), on_failure=on_failure)
            if counts_path:
                counts = ingest_counts(kept)
                with_retries(lambda: write_batch(counts, counts_path, batch_id), on_failure=on_failure)
            if samples_path:
                sample = hash_sample(stored_event(accepted(kept)), SAMPLE_ROWS, "event_id").drop("place")
                with_retries(lambda: write_batch(sample, samples_path, batch_id), on_failure=on_failure)
        finally:
            kept.unpersist()

    return write
