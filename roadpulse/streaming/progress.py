"""One metrics row per micro-batch, taken from Spark's own progress reports."""

from __future__ import annotations

import logging
import threading
from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from roadpulse.sinks.files import write_metrics

log = logging.getLogger(__name__)

OBSERVATION = "quality"

METRICS_TABLE = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("rows", T.LongType()),
        T.StructField("duration_sec", T.DoubleType()),
        T.StructField("throughput_rows_per_sec", T.DoubleType()),
        T.StructField("config", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("has_speed", T.LongType()),
        T.StructField("has_count", T.LongType()),
        T.StructField("dropped_late", T.LongType()),
        T.StructField("query_id", T.StringType()),
    ]
)

# Flushes that may fail in a row; then the rows waiting would only grow.
MAX_FAILURES = 20


def metrics_row(progress, config: str) -> tuple | None:
    """A metrics row, or nothing for a batch without readings.

    ``rows`` are readings with an event time; the duration is that of the whole
    trigger, not of a separate count. ``dropped_late`` counts what the watermark
    kept out of the windows, after map-side combining.
    """
    counts = progress.observedMetrics.get(OBSERVATION)
    if counts is None or counts["total"] == 0:
        return None
    seconds = progress.durationMs.get("triggerExecution", 0) / 1000
    started = datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00"))
    return (
        started.strftime("%Y-%m-%d %H:%M:%S"),
        progress.batchId,
        counts["total"],
        seconds,
        round(counts["total"] / seconds, 3) if seconds > 0 else 0.0,
        config,
        str(progress.runId),
        counts["has_speed"],
        counts["has_count"],
        sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators),
        str(progress.id),
    )


class MetricsListener(StreamingQueryListener):
    """Collects the progress of one named query; ``flush`` writes the rows.

    The callback only appends to a list. Writing happens on the job's own thread
    and may fail without harming the query; the rows are then kept for the next
    flush. The last flush, and the ``MAX_FAILURES``-th failure in a row, raise.

    A row is keyed by query and batch. The query keeps its id over restarts, so a
    flush that is repeated, or a batch that runs again, replaces its row. What was not
    flushed when the driver died is made again from the checkpoint by the next start.
    """

    def __init__(self, spark: SparkSession, query_name: str, config: str, path: str | None):
        self._spark = spark
        self._query_name = query_name
        self._config = config
        self._path = path
        self._rows: list[tuple] = []
        self._run_id = None
        self._lock = threading.Lock()
        self.ended = threading.Event()
        self.batches_seen = 0
        self._failures = 0

    def onQueryStarted(self, event) -> None:
        if event.name == self._query_name:
            self._run_id = event.runId

    def onQueryProgress(self, event) -> None:
        if event.progress.name != self._query_name:
            return
        row = metrics_row(event.progress, self._config)
        if row is not None:
            with self._lock:
                self._rows.append(row)
                self.batches_seen += 1
            _, batch, rows, seconds, rate, *_ = row
            log.info("%s, batch %d: %d rows, %.3f s, %.1f rows/s", self._config, batch, rows, seconds, rate)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.runId == self._run_id:
            self.ended.set()

    def take(self, rows: list[tuple]) -> None:
        """Rows of earlier batches to write with the next flush."""
        with self._lock:
            self._rows.extend(rows)

    def flush(self, last: bool = False) -> None:
        with self._lock:
            rows, self._rows = self._rows, []
        if not rows or self._path is None:
            return
        try:
            write_metrics(self._spark.createDataFrame(rows, METRICS_TABLE).coalesce(1), self._path)
            self._failures = 0
        except Exception:
            log.exception("could not write %d metrics rows", len(rows))
            with self._lock:
                self._rows = rows + self._rows
            self._failures += 1
            if last or self._failures >= MAX_FAILURES:
                raise
