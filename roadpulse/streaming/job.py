"""The streaming job: source, readings, watermark, window aggregate, sink.

One query reads the source once and keeps one copy of the window state. Data
quality and batch metrics ride along as an observation instead of as further
queries over the same source.
"""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from roadpulse.functions.labels import config_text
from roadpulse.operators.payloads import decode_payload
from roadpulse.operators.readings import canonical_readings, completeness, timed_records
from roadpulse.operators.windows import typed_window_aggregate, window_aggregate
from roadpulse.schemas import STATION_READING, SWEEP
from roadpulse.sinks.console import console_sink
from roadpulse.sinks.fanout import console_output, fan_out_sink, ledger_path, parquet_output
from roadpulse.sinks.files import parquet_sink, update_log_sink
from roadpulse.sources.files import stream_station_files
from roadpulse.sources.kafka import kafka_options, stream_messages
from roadpulse.storage import exists
from roadpulse.streaming.params import JobParams
from roadpulse.streaming.progress import OBSERVATION, MetricsListener
from roadpulse.streaming.recovery import recovered_metrics

log = logging.getLogger(__name__)

# How long to wait for the report that a stopped query has ended.
END_SECONDS = 600


def stream_readings(spark: SparkSession, params: JobParams) -> DataFrame:
    """Canonical readings of the configured source."""
    if params.source == "kafka":
        options = kafka_options(
            params.kafka_servers,
            params.kafka_topic,
            params.max_offsets_per_trigger,
            params.min_partitions,
        )
        records = decode_payload(
            stream_messages(spark, options), STATION_READING, params.drop_malformed
        )
    else:
        records = stream_station_files(
            spark,
            params.input_path,
            max_files_per_trigger=params.max_files_per_trigger,
            max_bytes_per_trigger=params.max_bytes_per_trigger,
            clean_source=params.clean_source,
            archive_path=params.archive_path,
        )
    return canonical_readings(records, params.event_time)


def windowed_stream(readings: DataFrame, window: str, watermark: str, counted: bool = False) -> DataFrame:
    """Observed, watermarked window aggregate of a stream of readings."""
    observed = readings.observe(OBSERVATION, *completeness())
    return window_aggregate(observed.withWatermark("ts", watermark), window, counted)


def typed_windowed_stream(
    spark: SparkSession, path: str, window: str = "5 seconds", watermark: str = "10 seconds"
) -> DataFrame:
    """Rounded window aggregate over typed CSV files, by the record's own region."""
    records = timed_records(stream_station_files(spark, path, typed=True))
    return typed_window_aggregate(records.withWatermark("ts", watermark), window)


def watch(spark: SparkSession, path: str, trigger: str = "20 seconds") -> StreamingQuery:
    """Print the rounded aggregate to the console as it changes."""
    return console_sink(
        typed_windowed_stream(spark, path), trigger, mode="update", rows=20
    ).start()


@dataclass
class RunningJob:
    query: StreamingQuery
    listener: MetricsListener
    spark: SparkSession

    def await_end(self, flush_seconds: float = 5) -> None:
        """Wait for the query, writing metrics rows on the way and at the end."""
        try:
            while not self.query.awaitTermination(flush_seconds):
                self.listener.flush()
        finally:
            self.stop()

    def stop(self) -> None:
        self.query.stop()
        # The last reports reach the listener a moment after the query ends; a
        # report that never comes must not pass for a batch without one.
        arrived = self.listener.ended.wait(END_SECONDS)
        self.spark.streams.removeListener(self.listener)
        self.listener.flush(last=True)
        if not arrived:
            raise TimeoutError(f"no end of {self.query.name} was reported; metrics rows may be missing")


def _refuse_other_outputs(spark: SparkSession, params: JobParams) -> None:
    """A job with a console writes folders per batch, one without a commit log: readers see one of them only."""
    if not exists(spark, f"{params.checkpoint_path}/offsets"):
        return
    if params.console != exists(spark, ledger_path(params.checkpoint_path)):
        raise ValueError(f"{params.checkpoint_path} was started {'without' if params.console else 'with'} a console")


def _sink(result: DataFrame, params: JobParams, name: str) -> DataStreamWriter:
    if params.console:
        outputs = {"files": parquet_output(params.output_path), "console": console_output()}
        return fan_out_sink(result, outputs, params.checkpoint_path, params.trigger, name, params.output_mode)
    sink = parquet_sink if params.sink == "parquet" else update_log_sink
    return sink(result, params.output_path, params.checkpoint_path, params.trigger, name)


def _lost_rows(spark: SparkSession, params: JobParams, config: str, recount: bool) -> list[tuple]:
    """Metrics rows of committed batches that were never written; at most those Spark keeps a checkpoint of."""
    try:
        lost = recovered_metrics(spark, params, config, recount)
        return [tuple(row) for row in lost.collect()] if lost is not None else []
    except Exception:
        # The stream does not depend on its metrics; the next start tries again.
        log.exception("could not make up for metrics rows of %s", params.checkpoint_path)
        return []


def start(
    spark: SparkSession, params: JobParams, readings: DataFrame | None = None
) -> RunningJob:
    """Start the job. ``readings`` replaces the configured source.

    Metrics rows that a driver took with it when it died are written with the first ones.
    """
    given = readings is not None
    if not given:
        readings = stream_readings(spark, params)
    _refuse_other_outputs(spark, params)
    windows = windowed_stream(readings, params.window, params.watermark, params.count_readings)
    result = windows
    if params.output_files:
        # Few files per batch; the rows here are closed windows, not readings.
        result = windows.repartition(params.output_files)
    name = f"roadpulse-{uuid.uuid4().hex}"
    config = config_text(params.source, params.window, params.trigger)
    listener = MetricsListener(spark, name, config, params.metrics_path)
    if params.metrics_path:
        listener.take(_lost_rows(spark, params, config, recount=not given))
    spark.streams.addListener(listener)
    try:
        query = _sink(result, params, name).start()
    except Exception:
        spark.streams.removeListener(listener)
        raise
    return RunningJob(query, listener, spark)


def run(spark: SparkSession, params: JobParams, readings: DataFrame | None = None) -> None:
    """Start the job and stay until it ends."""
    start(spark, params, readings).await_end()


def sweep(
    spark: SparkSession,
    base: JobParams,
    batches: int,
    configurations: list[tuple[str, str]] = SWEEP,
    readings: Callable[[], DataFrame] | None = None,
    limit_seconds: float = 3600,
) -> None:
    """Run every (window, trigger) pair until it has done ``batches`` batches.

    All runs add their rows to the base job's metrics, under their own label. A
    pair whose input ends first, or that reaches the time limit, keeps the rows it
    has; after the last pair the incomplete ones are raised as an error.
    """
    incomplete = []
    for window, trigger in configurations:
        suffix = f"w{window}-t{trigger}".replace(" ", "")
        params = replace(
            base,
            window=window,
            trigger=trigger,
            output_path=f"{base.output_path}/{suffix}",
            checkpoint_path=f"{base.checkpoint_path}/{suffix}",
        )
        job = start(spark, params, readings() if readings else None)
        deadline = time.monotonic() + limit_seconds
        try:
            while not job.query.awaitTermination(0.2):
                busy = job.query.status["isTriggerActive"]
                done = job.listener.batches_seen >= batches or time.monotonic() > deadline
                if done and not busy:
                    break
        finally:
            job.stop()
        if job.listener.batches_seen < batches:
            incomplete.append(f"{window} every {trigger}: {job.listener.batches_seen}")
    if incomplete:
        raise RuntimeError(f"fewer than {batches} batches for {'; '.join(incomplete)}")
