"""The report tables, by name; any plotting tool can draw them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadpulse.operators import batch_metrics as stats
from roadpulse.operators import trends
from roadpulse.sources.files import read_aggregates, read_early_metrics, read_metrics
from roadpulse.storage import materialise

METRICS = ("avg_speed", "total_vehicles", "congestion_index")


def traffic_tables(spark: SparkSession, *aggregate_paths: str, top: int = 5) -> dict[str, DataFrame]:
    """What the window aggregates say about traffic."""
    aggregates = read_aggregates(spark, *aggregate_paths)
    # Written once: all pivots read it, and first the regions that have a value.
    rolling = materialise(trends.rolling_measures(aggregates), "rolling")
    pivots = {name: name for name in METRICS}
    pivots |= {"rolling_avg_speed": "avg_speed_roll", "rolling_congestion": "congestion_roll"}
    regions = trends.regions_by_metric(rolling, list(pivots.values()))
    tables = {name: trends.pivot_by_region(rolling, m, regions[m]) for name, m in pivots.items()}
    tables |= {f"{name}_by_region": trends.mean_by_region(rolling, m) for name, m in pivots.items()}
    tables["congestion_vs_speed"] = trends.congestion_against_speed(aggregates)
    tables["peak_congestion"] = trends.peak_congestion(aggregates, top)
    return tables


SUMMARY_COLUMNS = ("duration_sec", "throughput_rows_per_sec", "config", "timestamp", "batch_id")


def system_tables(
    spark: SparkSession, metrics_path: str, layout: str = "named"
) -> dict[str, DataFrame]:
    """What the batch metrics say about the streaming job, as far as their layout goes.

    The summary needs labelled durations and times; ``early`` files, without a header,
    have only row counts.
    """
    if layout == "early":
        early = materialise(read_early_metrics(spark, metrics_path), "metrics")
        return {"batch_rows": early.select("timestamp", "batch_id", "rows")}
    # The CSV is parsed once for all tables.
    raw = materialise(read_metrics(spark, metrics_path), "metrics")
    metrics = stats.normalise_metrics(raw)
    summary = {}
    if set(SUMMARY_COLUMNS) <= set(raw.columns):
        summary["steady_state_summary"] = stats.steady_state_summary(raw)
    return {
        **summary,
        "batch_size_by_config": stats.batch_size_by_config(metrics),
        "latency_jitter": stats.latency_jitter(metrics),
        "throughput_efficiency": stats.throughput_efficiency(metrics),
        "latency_histogram": stats.latency_histogram(metrics),
        "scaling_curve": stats.scaling_curve(metrics),
    }


def write_tables(tables: dict[str, DataFrame], folder: str) -> None:
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{folder}/{name}")
