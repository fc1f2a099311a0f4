"""The registered queries: one per operator, over the given tables.

Each takes ``(spark, sf_dir)`` and returns a DataFrame. Floating-point results
of sums are rounded to six digits, since the order of a distributed sum is not
fixed, and times are returned without a zone. Queries over files or streams write the
files to the cluster's shared folder first.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.functions import cells, labels, lanes
from roadpulse.operators import (
    batch_metrics as stats,
    chunks,
    cleaning,
    payloads,
    readings,
    trends,
    windows,
)
from roadpulse.plans import feeds
from roadpulse.schemas import BASE_COLUMNS, FLOW_NAMES, SPEED_NAMES, STATION_READING, load_schema
from roadpulse.sinks import fanout
from roadpulse.sinks import files as sinks
from roadpulse.sinks.parts import compact_parts
from roadpulse.sources import files as sources
from roadpulse.storage import fresh_path, materialise
from roadpulse.streaming import job, open_windows
from roadpulse.streaming.params import JobParams

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(plan: Query, digits: int | None = None) -> Query:
    """Register ``plan`` under its own name."""

    @wraps(plan)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # The tables hold times without a zone; streams need times with one. The result
        # is computed after this returns, so the session has to stay in UTC.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return presented(plan(spark, str(sf_dir).rstrip("/")), digits)

    QUERIES[plan.__name__] = run
    return run


def measured(plan: Query) -> Query:
    """Register a plan whose floating-point results come from sums."""
    return query(plan, digits=6)


def steady(value: Column, digits: int) -> Column:
    """A floating-point result for comparison: its last bits, which depend on the
    order of a distributed sum, are cut off before it is rounded. Infinite and very
    large values are left to plain rounding.
    """
    cut = F.round(value.try_cast("decimal(38,10)"), digits).cast("double")
    return F.coalesce(cut, F.round(value, digits))


def presented(rows: DataFrame, digits: int | None) -> DataFrame:
    def column(field: T.StructField) -> Column:
        name = field.name.replace("`", "``")
        value = F.col(f"`{name}`")
        if isinstance(field.dataType, T.TimestampType):
            value = value.cast("timestamp_ntz")
        elif digits is not None and isinstance(field.dataType, T.DoubleType):
            value = steady(value, digits)
        return value.alias(field.name)

    return rows.select([column(field) for field in rows.schema])


# Plain names for the station file's columns in query results.
PLAIN_NAMES = {
    "Timestamp": "time_text",
    "Station": "station",
    "District": "district",
    "Freeway #": "freeway",
    "Direction of Travel": "direction",
    "Lane Type": "lane_type",
    "Station Length": "station_length",
    "Samples": "samples",
    "% Observed": "pct_observed",
    "Total Flow": "total_flow",
    "Avg Occupancy": "avg_occupancy",
    "Avg Speed": "avg_speed",
}


def plain(records: DataFrame) -> DataFrame:
    return records.withColumnsRenamed(PLAIN_NAMES).withColumnRenamed("Region", "region")


def station_csv(spark: SparkSession, sf_dir: str) -> str:
    """The station records as a folder of CSV files with headers."""
    path = fresh_path(spark, "station-csv")
    sinks.write_csv(feeds.station_cells(feeds.station_records(spark, sf_dir)), path)
    return path


def drained(spark: SparkSession, stream: DataFrame, checkpoint: str | None = None) -> DataFrame:
    """Run a stream over all available input and read what it wrote."""
    output = fresh_path(spark, "stream")
    checkpoint = checkpoint or fresh_path(spark, "stream-checkpoint")
    sinks.parquet_sink(stream, output, checkpoint, "available-now").start().awaitTermination()
    return sources.read_aggregates(spark, output)


def job_params(spark: SparkSession, **changes) -> JobParams:
    defaults = {
        "input_path": "given",
        "output_path": fresh_path(spark, "job-output"),
        "checkpoint_path": fresh_path(spark, "job-checkpoint"),
        "trigger": "available-now",
        "window": "1 hour",
    }
    return JobParams.from_mapping({**defaults, **changes})


# --- sources -----------------------------------------------------------------


@query
def src_csv_stream(spark, sf_dir):
    stream = sources.stream_station_files(spark, station_csv(spark, sf_dir))
    return plain(drained(spark, stream))


@query
def src_csv_typed(spark, sf_dir):
    stream = sources.stream_station_files(spark, station_csv(spark, sf_dir), typed=True)
    return plain(drained(spark, stream))


@query
def src_json_decode(spark, sf_dir):
    return plain(payloads.decode_payload(feeds.messages(spark, sf_dir)))


@query
def json_decode_strict(spark, sf_dir):
    decoded = payloads.decode_payload(feeds.messages(spark, sf_dir), drop_malformed=True)
    return plain(decoded)


@query
def src_station_text(spark, sf_dir):
    path = fresh_path(spark, "station-text")
    feeds.station_lines(spark, sf_dir).write.text(path)
    return plain(sources.read_station_text(spark, path))


@query
def src_header_sniff(spark, sf_dir):
    named, unnamed = station_csv(spark, sf_dir), fresh_path(spark, "station-text")
    feeds.station_lines(spark, sf_dir).write.text(unnamed)
    layouts = {
        path: sources.read_station_files(spark, path).select(
            F.lit(layout).alias("layout"), *[F.col(name) for name in BASE_COLUMNS]
        )
        for layout, path in (("named", named), ("unnamed", unnamed))
    }
    return plain(layouts[named].unionByName(layouts[unnamed]))


@query
def lane_layout(spark, sf_dir):
    width = F.size(F.split("line", ",", -1))
    return (
        feeds.station_lines(spark, sf_dir)
        .groupBy(width.alias("n_columns"))
        .agg(F.count(F.lit(1)).alias("n_lines"))
        .select(
            "n_columns",
            "n_lines",
            lanes.lane_count(F.col("n_columns")).alias("n_lanes"),
            F.array_join(lanes.layout_names(F.col("n_columns")), "|").alias("column_names"),
        )
    )


@query
def src_csv_batch(spark, sf_dir):
    return plain(sources.read_station_csv(spark, station_csv(spark, sf_dir)))


@measured
def src_parquet_parts(spark, sf_dir):
    path = fresh_path(spark, "aggregates")
    windows.window_aggregate(feeds.event_readings(spark, sf_dir), "1 hour").write.parquet(path)
    return sources.read_aggregates(spark, path)


@measured
def src_metrics(spark, sf_dir):
    path = fresh_path(spark, "metrics")
    sinks.write_csv(feeds.batch_metrics(spark, sf_dir), path)
    return sources.read_metrics(spark, path).withColumnRenamed("timestamp", "logged_at")


@query
def src_described_schema(spark, sf_dir):
    """Orders as headerless CSV, read by a schema that a JSON file describes."""
    orders, described = fresh_path(spark, "orders"), fresh_path(spark, "schema")
    fields = {"o_orderkey": "integer", "o_orderstatus": "string", "o_totalprice": "double"}
    feeds.table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_orderstatus", "cast(o_totalprice as double)"
    ).write.csv(orders)
    text = json.dumps({"fields": [{"name": name, "type": kind} for name, kind in fields.items()]})
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(described)
    return spark.read.schema(load_schema(spark, described)).csv(orders)


@query
def src_metrics_early(spark, sf_dir):
    path = fresh_path(spark, "metrics")
    feeds.batch_metrics(spark, sf_dir).select("timestamp", "batch_id", "rows").write.csv(path)
    return sources.read_early_metrics(spark, path).withColumnRenamed("timestamp", "logged_at")


# --- sinks -------------------------------------------------------------------


@measured
def sink_parquet_stream(spark, sf_dir):
    params = job_params(spark)
    job.run(spark, params, feeds.stream_event_readings(spark, sf_dir))
    return sources.read_aggregates(spark, params.output_path)


@query
def sink_batch_metrics(spark, sf_dir):
    params = job_params(spark, metrics_path=fresh_path(spark, "metrics"))
    job.run(spark, params, feeds.stream_event_readings(spark, sf_dir))
    return _metrics_facts(sources.read_metrics(spark, params.metrics_path))


def _metrics_facts(metrics: DataFrame) -> DataFrame:
    """What does not depend on how fast the machine is."""
    return metrics.select("config", "batch_id", "rows", "has_speed", "has_count", "dropped_late")


@query
def quality_counts(spark, sf_dir):
    return readings.quality_counts(
        readings.canonical_readings(feeds.station_records(spark, sf_dir))
    )


@query
def sink_csv(spark, sf_dir):
    path = fresh_path(spark, "prepared")
    prepared = cleaning.prepare(feeds.station_records(spark, sf_dir, feeds.US_TIME))
    sinks.write_csv(prepared, path)
    read_back = sources.read_station_csv(spark, path)
    numeric = {
        name: cells.to_number(F.col(name)) for name in ("% Observed", "Total Flow", "Avg Speed")
    }
    return plain(read_back.withColumns(numeric))


@query
def chunk_assign(spark, sf_dir):
    records = feeds.station_records(spark, sf_dir).select("event_id", "Timestamp", "Station")
    order = ["Timestamp", "Station", "event_id"]
    return chunks.assign_chunks(records, order, 1000, from_scan=True).select(
        "event_id", "row_position", "chunk_id"
    )


@query
def chunk_input_order(spark, sf_dir):
    """Chunks of CSV files as their rows stand in them."""
    path = fresh_path(spark, "station-csv")
    records = feeds.station_records(spark, sf_dir).select("event_id", "Timestamp", "Station")
    sinks.write_csv(records.repartitionByRange(4, "event_id").sortWithinPartitions("event_id"), path)
    return chunks.assign_chunks(sources.read_station_csv(spark, path), size=1000).select(
        F.col("event_id").cast("bigint").alias("event_id"), "row_position", "chunk_id"
    )


@query
def sink_chunks(spark, sf_dir):
    path = fresh_path(spark, "chunks")
    records = feeds.station_records(spark, sf_dir).select("event_id", "Timestamp", "Station")
    order = ["Timestamp", "Station", "event_id"]
    chunks.write_chunks(chunks.assign_chunks(records, order, 1000, from_scan=True, borders=True), path)
    written = spark.read.option("header", True).csv(path).select(
        F.col("chunk").cast("bigint").alias("chunk_id"),
        F.col("event_id").cast("bigint").alias("event_id"),
        F.col("_metadata.file_path").alias("file"),
    )
    return written.groupBy("chunk_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("file").alias("n_files"),
        F.sum("event_id").alias("event_id_sum"),
    )


@query
def sink_json_encode(spark, sf_dir):
    records = feeds.station_cells(feeds.station_records(spark, sf_dir))
    return payloads.encode_payload(records)


# --- projections and filters ---------------------------------------------------


@query
def null_if_empty(spark, sf_dir):
    return feeds.station_records(spark, sf_dir).select(
        "event_id", cells.blank_to_null(F.col("Total Flow")).alias("flow_text")
    )


@query
def coalesce_aliases(spark, sf_dir):
    records = feeds.station_records(spark, sf_dir).select(
        "event_id",
        F.col("Total Flow").alias("Total_Flow"),
        F.col("Samples").alias("Flow"),
        F.col("Avg Speed").alias("Speed (mph)"),
    )
    return records.select(
        "event_id",
        cells.first_filled(records, FLOW_NAMES).alias("flow_text"),
        cells.first_filled(records, SPEED_NAMES).alias("speed_text"),
        cells.first_filled(records, ["Occupancy"]).alias("no_such_text"),
    )


@query
def cast_measures(spark, sf_dir):
    return feeds.station_records(spark, sf_dir).select(
        "event_id",
        cells.to_whole(F.col("Total Flow")).alias("vehicle_count"),
        cells.to_number(F.col("Avg Speed")).alias("speed"),
    )


@query
def region_map(spark, sf_dir):
    return feeds.station_records(spark, sf_dir).select(
        "event_id", cells.region_of(F.col("District")).alias("region")
    )


@query
def parse_event_time(spark, sf_dir):
    return (
        feeds.station_records(spark, sf_dir)
        .select("event_id", cells.read_time(F.col("Timestamp")).alias("event_time"))
        .where(F.col("event_time").isNotNull())
    )


@query
def canonical_reading(spark, sf_dir):
    return readings.canonical_readings(feeds.station_records(spark, sf_dir))


@query
def event_time_ingest(spark, sf_dir):
    decoded = payloads.decode_payload(feeds.messages(spark, sf_dir), STATION_READING)
    return readings.canonical_readings(decoded, event_time="ingest")


@query
def keep_base_columns(spark, sf_dir):
    records = feeds.station_records(spark, sf_dir)
    wide = records.select("*", *feeds.lane_cells(records))
    return plain(
        cleaning.keep_base_columns(wide).withColumn(
            "n_removed", F.lit(len(cleaning.lane_columns(wide)))
        )
    )


@query
def drop_unobserved(spark, sf_dir):
    records = feeds.station_records(spark, sf_dir)
    return plain(cleaning.drop_unobserved(records).select("event_id", "% Observed"))


@query
def drop_null_flow(spark, sf_dir):
    records = feeds.station_records(spark, sf_dir)
    return plain(cleaning.drop_missing(records, "Total Flow").select("event_id", "Total Flow"))


@query
def drop_null_speed(spark, sf_dir):
    records = feeds.station_records(spark, sf_dir)
    return plain(cleaning.drop_missing(records, "Avg Speed").select("event_id", "Avg Speed"))


@query
def cleaning_audit(spark, sf_dir):
    return cleaning.cleaning_audit(feeds.station_records(spark, sf_dir))


@query
def reformat_timestamp(spark, sf_dir):
    records = feeds.station_records(spark, sf_dir, feeds.US_TIME)
    return plain(cleaning.reformat_times(records).select("event_id", "Timestamp"))


@query
def region_constant(spark, sf_dir):
    return cleaning.add_region(feeds.station_records(spark, sf_dir)).select("event_id", "region")


@query
def prepared_records(spark, sf_dir):
    records = feeds.station_records(spark, sf_dir, feeds.US_TIME)
    return plain(cleaning.prepare(records, region_mode="district"))


@query
def to_numeric(spark, sf_dir):
    return feeds.station_records(spark, sf_dir).select(
        "event_id",
        cells.to_number(F.col("Total Flow")).alias("flow"),
        cells.to_number(F.col("Avg Speed")).alias("speed"),
        cells.to_number(F.col("% Observed")).alias("pct_observed"),
    )


@query
def distinct_district(spark, sf_dir):
    return plain(cleaning.distinct_districts(feeds.station_records(spark, sf_dir)))


@query
def head_rows(spark, sf_dir):
    records = feeds.station_records(spark, sf_dir)
    return plain(
        cleaning.head_rows(records, ["Timestamp", "event_id"]).select(
            "event_id", "Timestamp", "Station", "Total Flow"
        )
    )


@query
def payload_key_profile(spark, sf_dir):
    return payloads.payload_key_profile(feeds.messages(spark, sf_dir))


@query
def payload_samples(spark, sf_dir):
    samples = payloads.payload_samples(feeds.messages(spark, sf_dir))
    return samples.withColumnRenamed("timestamp", "kafka_ts")


# --- batch metrics -------------------------------------------------------------


@measured
def metrics_normalise(spark, sf_dir):
    metrics = feeds.batch_metrics(spark, sf_dir).select(
        "batch_id",
        "rows",
        (F.col("duration_sec") * 1000).cast("string").alias("batch_duration"),
        F.when(F.col("batch_id") % 9 == 0, "n/a")
        .otherwise(F.col("throughput_rows_per_sec").cast("string"))
        .alias("processed_rps"),
    )
    return stats.normalise_metrics(metrics).select(
        "batch_id", "rows", "duration_sec", "throughput_rps", "config"
    )


@query
def dropna_subset(spark, sf_dir):
    metrics = feeds.batch_metrics(spark, sf_dir).withColumns(
        {
            "config": F.when(F.col("batch_id") % 5 == 0, "file|window=wide").otherwise(
                F.col("config")
            )
        }
    )
    return stats.with_config_seconds(metrics).select(
        "batch_id", "window_seconds", "trigger_seconds"
    )


@query
def config_label(spark, sf_dir):
    return feeds.table(spark, sf_dir, "events").select(
        "event_id",
        labels.config_label(
            F.col("event_type"),
            F.concat((F.col("event_id") % 60 + 1).cast("string"), F.lit(" seconds")),
            F.concat((F.col("user_id") % 20 + 1).cast("string"), F.lit(" seconds")),
        ).alias("config"),
    )


@query
def parse_config(spark, sf_dir):
    return feeds.batch_metrics(spark, sf_dir).select(
        "batch_id",
        labels.seconds_of(F.col("config"), "window").alias("window_seconds"),
        labels.seconds_of(F.col("config"), "trigger").alias("trigger_seconds"),
    )


@query
def short_label(spark, sf_dir):
    parsed = stats.with_config_seconds(feeds.batch_metrics(spark, sf_dir))
    return parsed.select(
        "batch_id",
        labels.short_label(F.col("window_seconds"), F.col("trigger_seconds")).alias("short_label"),
    )


@measured
def batch_size_by_config(spark, sf_dir):
    return stats.batch_size_by_config(
        stats.normalise_metrics(feeds.batch_metrics(spark, sf_dir))
    )


@measured
def latency_jitter(spark, sf_dir):
    return stats.latency_jitter(stats.normalise_metrics(feeds.batch_metrics(spark, sf_dir)))


@measured
def steady_state_summary(spark, sf_dir):
    return stats.steady_state_summary(feeds.batch_metrics(spark, sf_dir))


@measured
def warmup_drop(spark, sf_dir):
    parsed = stats.with_config_seconds(feeds.batch_metrics(spark, sf_dir))
    return stats.drop_warmup(parsed).select(
        "window_seconds", "trigger_seconds", "batch_id", "duration_sec"
    )


@measured
def throughput_efficiency(spark, sf_dir):
    metrics = materialise(feeds.batch_metrics(spark, sf_dir), "metrics")
    return stats.throughput_efficiency(stats.normalise_metrics(metrics))


@measured
def latency_histogram(spark, sf_dir):
    metrics = materialise(feeds.batch_metrics(spark, sf_dir), "metrics")
    return stats.latency_histogram(stats.normalise_metrics(metrics))


@measured
def scaling_curve(spark, sf_dir):
    return stats.scaling_curve(stats.normalise_metrics(feeds.batch_metrics(spark, sf_dir)))


# --- window aggregates and trends ------------------------------------------------


@measured
def congestion_index(spark, sf_dir):
    """The flagship: hourly speed, volume and congestion per region."""
    return windows.window_aggregate(feeds.event_readings(spark, sf_dir), "1 hour")


def _plain_aggregate(spark, sf_dir, width):
    return windows.window_aggregate(feeds.event_readings(spark, sf_dir), width).drop(
        "congestion_index"
    )


@measured
def window_agg_5s(spark, sf_dir):
    return _plain_aggregate(spark, sf_dir, "5 seconds")


@measured
def window_agg_10s(spark, sf_dir):
    return _plain_aggregate(spark, sf_dir, "10 seconds")


@measured
def window_agg_1h(spark, sf_dir):
    return _plain_aggregate(spark, sf_dir, "1 hour")


@measured
def window_agg_shipments(spark, sf_dir):
    return windows.window_aggregate(feeds.shipment_readings(spark, sf_dir), "1 day")


@measured
def window_agg_dirty(spark, sf_dir):
    """From station records to aggregates, with a group of unknown region."""
    records = feeds.station_records(spark, sf_dir)
    return windows.window_aggregate(readings.canonical_readings(records), "1 hour")


@measured
def window_agg_rounded(spark, sf_dir):
    records = feeds.station_records(spark, sf_dir)
    typed = records.select(
        F.col("ts"),
        F.col("Region").alias("region"),
        *[cells.to_number(F.col(name)).alias(name) for name in ("Total Flow", "Avg Speed")],
    )
    return windows.typed_window_aggregate(typed, "1 hour")


@measured
def pivot_avg_speed(spark, sf_dir):
    return trends.pivot_by_region(feeds.hourly_aggregates(spark, sf_dir), "avg_speed")


@measured
def pivot_total_vehicles(spark, sf_dir):
    return trends.pivot_by_region(feeds.hourly_aggregates(spark, sf_dir), "total_vehicles")


@measured
def pivot_congestion(spark, sf_dir):
    return trends.pivot_by_region(feeds.hourly_aggregates(spark, sf_dir), "congestion_index")


@measured
def mean_by_region(spark, sf_dir):
    return trends.mean_by_region(feeds.hourly_aggregates(spark, sf_dir), "avg_speed")


@measured
def congestion_vs_speed(spark, sf_dir):
    records = feeds.station_records(spark, sf_dir)
    aggregates = windows.window_aggregate(readings.canonical_readings(records), "1 hour")
    return trends.congestion_against_speed(aggregates)


@measured
def rolling_mean_3(spark, sf_dir):
    return trends.rolling_measures(feeds.hourly_aggregates(spark, sf_dir)).select(
        "region", "window_start", "avg_speed_roll", "congestion_roll"
    )


def _rolling_table(spark, sf_dir):
    return materialise(
        trends.rolling_measures(feeds.hourly_aggregates(spark, sf_dir)), "rolling"
    )


@measured
def pivot_rolling_speed(spark, sf_dir):
    return trends.pivot_by_region(_rolling_table(spark, sf_dir), "avg_speed_roll")


@measured
def pivot_rolling_congestion(spark, sf_dir):
    return trends.pivot_by_region(_rolling_table(spark, sf_dir), "congestion_roll")


@measured
def sorted_aggregates(spark, sf_dir):
    aggregates = windows.window_aggregate(feeds.event_readings(spark, sf_dir), "1 hour")
    return trends.sorted_aggregates(aggregates)


@measured
def peak_congestion(spark, sf_dir):
    aggregates = windows.window_aggregate(feeds.event_readings(spark, sf_dir), "1 hour")
    return trends.peak_congestion(aggregates)


@measured
def union_all_sources(spark, sf_dir):
    paths = [fresh_path(spark, "aggregates") for _ in range(2)]
    for source, path in zip((feeds.event_readings, feeds.shipment_readings), paths):
        windows.window_aggregate(source(spark, sf_dir), "1 day").write.parquet(path)
    return sources.read_aggregates(spark, *paths)


# --- streams -------------------------------------------------------------------


@query
def stream_watermark(spark, sf_dir):
    """A watermark by itself removes no reading."""
    stream = feeds.stream_event_readings(spark, sf_dir).withWatermark("ts", "20 seconds")
    return drained(spark, stream)


@measured
def stream_window_agg(spark, sf_dir):
    stream = feeds.stream_event_readings(spark, sf_dir)
    return drained(spark, job.windowed_stream(stream, "10 seconds", "20 seconds"))


@measured
def stream_station_job(spark, sf_dir):
    """The whole job from CSV files to aggregates."""
    params = job_params(spark, input_path=station_csv(spark, sf_dir))
    job.run(spark, params)
    return sources.read_aggregates(spark, params.output_path)


@measured
def stream_message_job(spark, sf_dir):
    """From JSON messages to aggregates by broker time."""
    inbox = fresh_path(spark, "messages")
    feeds.messages(spark, sf_dir).write.parquet(inbox)
    stream = spark.readStream.schema(spark.read.parquet(inbox).schema).parquet(inbox)
    records = payloads.decode_payload(stream, STATION_READING)
    params = job_params(spark)
    job.run(spark, params, readings.canonical_readings(records, event_time="ingest"))
    return sources.read_aggregates(spark, params.output_path)


@measured
def stream_typed_updates(spark, sf_dir):
    """Typed CSV files to rounded aggregates in update mode."""
    log, checkpoint = fresh_path(spark, "updates"), fresh_path(spark, "updates-checkpoint")
    stream = job.typed_windowed_stream(spark, station_csv(spark, sf_dir))
    sinks.update_log_sink(stream, log, checkpoint, "available-now").start().awaitTermination()
    keys = ["region", "window_start", "window_end"]
    return sinks.read_updates(spark, log, keys)


def _late_arrivals(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Ten days at a time; errors of the first ten days arrive last."""
    events = feeds.event_readings(spark, sf_dir)
    ten_days, twenty_days = (
        F.lit(day).cast("timestamp_ntz") for day in ("2024-01-11", "2024-01-21")
    )
    # An event without a type is not late.
    late = F.col("region").eqNullSafe("error") & (F.col("ts") < ten_days)
    return [
        events.where(~late & (F.col("ts") < ten_days)),
        events.where((F.col("ts") >= ten_days) & (F.col("ts") < twenty_days)),
        events.where(F.col("ts") >= twenty_days),
        events.where(late),
    ]


@measured
def stream_late_data(spark, sf_dir):
    """Errors of the first ten days arrive last and are dropped as late."""
    return _in_turns(spark, _late_arrivals(spark, sf_dir))


@measured
def stream_resume(spark, sf_dir):
    """Stopped after the first half, resumed from the checkpoint for the rest."""
    events = feeds.event_readings(spark, sf_dir)
    half = F.lit("2024-01-16").cast("timestamp_ntz")
    return _in_turns(spark, [events.where(F.col("ts") < half), events.where(F.col("ts") >= half)])


@measured
def sink_parquet_compacted(spark, sf_dir):
    """A job started three times; its output is folded before the last start, which adds files."""
    events = feeds.event_readings(spark, sf_dir)
    days = [F.lit(day).cast("timestamp_ntz") for day in ("2024-01-11", "2024-01-21")]
    arrivals = [
        events.where(F.col("ts") < days[0]),
        events.where((F.col("ts") >= days[0]) & (F.col("ts") < days[1])),
        events.where(F.col("ts") >= days[1]),
    ]
    params = _run_in_turns(spark, arrivals[:2])
    compact_parts(spark, params.output_path)
    params = _run_in_turns(spark, arrivals[2:], params)
    return sources.read_aggregates(spark, params.output_path)


def _run_in_turns(
    spark: SparkSession, arrivals: list[DataFrame], started: JobParams | None = None, **changes
) -> JobParams:
    """Let each part arrive, run the job to its end, and start it again."""
    params = started or job_params(spark, input_path=fresh_path(spark, "inbox"), **changes)
    inbox = params.input_path
    for part in arrivals:
        part.withColumn("ts", F.col("ts").cast("timestamp")).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(spark.read.parquet(inbox).schema).parquet(inbox)
        job.run(spark, params, stream)
    return params


def _in_turns(spark: SparkSession, arrivals: list[DataFrame]) -> DataFrame:
    return sources.read_aggregates(spark, _run_in_turns(spark, arrivals).output_path)


@measured
def stream_fan_out(spark, sf_dir):
    """Closed windows to Parquet and to CSV from one query."""
    paths = {"parquet": fresh_path(spark, "fan-parquet"), "csv": fresh_path(spark, "fan-csv")}
    stream = job.windowed_stream(feeds.stream_event_readings(spark, sf_dir), "1 hour", "20 seconds")
    outputs = {"parquet": fanout.parquet_output(paths["parquet"]), "csv": fanout.csv_output(paths["csv"])}
    fanout.fan_out_sink(stream, outputs, fresh_path(spark, "fan-checkpoint"), "available-now").start().awaitTermination()
    written = {
        "parquet": sources.read_aggregates(spark, paths["parquet"]),
        "csv": spark.read.schema(stream.schema).option("header", True).csv(f"{paths['csv']}/batch=*"),
    }
    return written["parquet"].withColumn("output", F.lit("parquet")).unionByName(
        written["csv"].withColumn("output", F.lit("csv"))
    )


@measured
def stream_open_windows(spark, sf_dir):
    """Emitted and open windows: all of the batch aggregate, the newest windows included."""
    params = job_params(spark)
    job.run(spark, params, feeds.stream_event_readings(spark, sf_dir))
    return open_windows.current_windows(spark, params.output_path, params.checkpoint_path)


@query
def stream_readings_ledger(spark, sf_dir):
    """Where the readings of ``stream_late_data`` went, the late ones counted one by one."""
    params = _run_in_turns(
        spark, _late_arrivals(spark, sf_dir), count_readings=True, metrics_path=fresh_path(spark, "metrics")
    )
    return open_windows.readings_ledger(spark, params.output_path, params.checkpoint_path, params.metrics_path)


@measured
def stream_update_mode(spark, sf_dir):
    """The state after all updates, windows still open included."""
    params = job_params(spark, sink="updates", output_mode="update")
    job.run(spark, params, feeds.stream_event_readings(spark, sf_dir))
    keys = ["region", "window_start", "window_end"]
    sinks.compact_updates(spark, params.output_path, keys)
    return sinks.read_updates(spark, params.output_path, keys)


@query
def stream_paced(spark, sf_dir):
    """Four files, one per batch in the order they arrive, through the metrics sink."""
    inbox = fresh_path(spark, "inbox")
    records = feeds.station_records(spark, sf_dir)
    for turn in range(4):
        part = feeds.station_cells(records.where(F.col("event_id") % 4 == turn)).coalesce(1)
        sinks.write_csv(part, inbox, mode="append")
    params = job_params(
        spark,
        input_path=inbox,
        max_files_per_trigger=1,
        metrics_path=fresh_path(spark, "metrics"),
    )
    job.run(spark, params)
    return sources.read_metrics(spark, params.metrics_path).select("batch_id", "rows", "has_speed", "has_count")


@query
def sweep_metrics(spark, sf_dir):
    """Six configurations over the same readings."""
    params = job_params(spark, metrics_path=fresh_path(spark, "metrics"))
    job.sweep(
        spark, params, batches=1, readings=lambda: feeds.stream_event_readings(spark, sf_dir)
    )
    return _metrics_facts(sources.read_metrics(spark, params.metrics_path))
