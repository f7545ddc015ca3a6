"""Operating metrics out of streaming progress, for the `system_metrics` table."""

from __future__ import annotations

import datetime
from threading import Event, Lock, Thread

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from watchlens.schemas import TABLES

# The documented metric names.
CONSUMED = "kafka_messages_consumed_total"
SAVED = "kafka_messages_saved_total"
FLUSHES = "kafka_batch_flush_total"
LATENCY = "kafka_processing_latency_seconds"
PARSE_ERRORS = "kafka_parsing_errors_total"
SAVE_ERRORS = "mysql_save_errors_total"
RUNNING = "kafka_consumer_running"
LATE_ROWS = "rows_dropped_by_watermark_total"


class ProgressRecorder(StreamingQueryListener):
    """Collects metric rows of running queries; `flush` appends them to a table folder.

    A few numbers per micro-batch reach the driver, never rows; flush after each batch
    (`queries.start_ingest` does) to keep them few. Totals run since the recorder was made.

    With a `query` name it hears that query alone. With a `path` it then also takes its leave when that query ends: the
    rest, the last batch's numbers among them, is written there, the listener is removed, and `closed` is set.
    """

    def __init__(
        self, observed: str = "ingest", query: str | None = None, spark: SparkSession | None = None, path: str | None = None
    ) -> None:
        self._observed = observed
        self._query, self._spark, self._path = query, spark, path
        self.closed = Event()
        self.error: Exception | None = None
        self._rows: list[tuple] = []
        self._totals: dict[tuple[str, str], float] = {}
        self._names: dict[str, str] = {}
        self._lock = Lock()

    def _record(self, name: str, value: float, query: str) -> None:
        now = datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)
        self._rows.append((name, float(value), {"query": query}, now, now))

    def _add(self, name: str, value: float, query: str) -> None:
        total = self._totals.get((name, query), 0.0) + value
        self._totals[(name, query)] = total
        self._record(name, total, query)

    def save_failed(self, error: Exception, query: str = "ingest") -> None:
        """For the `on_failure` of a sink."""
        with self._lock:
            self._add(SAVE_ERRORS, 1, query)

    def onQueryStarted(self, event) -> None:
        if self._query and event.name != self._query:
            return
        with self._lock:
            self._names[str(event.runId)] = event.name or str(event.id)
            self._record(RUNNING, 1, event.name or str(event.id))

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if self._query and str(progress.runId) not in self._names:
            return
        query = progress.name or str(progress.id)
        counts = (progress.observedMetrics or {}).get(self._observed)
        with self._lock:
            self._add(CONSUMED, progress.numInputRows, query)
            self._add(FLUSHES, 1, query)
            self._record(LATENCY, progress.batchDuration / 1000.0, query)
            self._add(LATE_ROWS, sum(op.numRowsDroppedByWatermark for op in progress.stateOperators), query)
            if counts is not None:
                self._add(SAVED, counts["saved"], query)
                self._add(PARSE_ERRORS, counts["errors"], query)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if self._query and str(event.runId) not in self._names:
            return
        with self._lock:
            self._record(RUNNING, 0, self._names.pop(str(event.runId), str(event.id)))
        if self._path:
            # Not on the listener's own thread, which other queries wait for.
            Thread(target=self._close, daemon=True).start()

    def _close(self) -> None:
        try:
            self._spark.streams.removeListener(self)
            self.flush(self._spark, self._path)
        except Exception as error:
            self.error = error
        finally:
            self.closed.set()

    def wait(self, seconds: float = 60) -> None:
        """After the query has ended: until all its numbers are written."""
        if not self.closed.wait(seconds):
            raise TimeoutError("the query's last metrics are not written yet")
        if self.error:
            raise self.error

    def take(self, spark: SparkSession) -> DataFrame:
        """The rows collected since the last call."""
        with self._lock:
            rows, self._rows = self._rows, []
        return spark.createDataFrame(rows, TABLES["system_metrics"].columns)

    def flush(self, spark: SparkSession, path: str) -> None:
        with self._lock:
            if not self._rows:
                return
        self.take(spark).coalesce(1).write.mode("append").parquet(path)
