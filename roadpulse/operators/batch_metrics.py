"""Statistics of streaming batches, one metrics row per micro-batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from roadpulse.functions.cells import to_number
from roadpulse.functions.labels import seconds_of, short_label
from roadpulse.storage import materialise


_LAST_BATCH, _LAST_TIME = 2**61, 2**63 - 1


def normalise_metrics(metrics: DataFrame) -> DataFrame:
    """Give metrics of any accepted layout ``duration_sec``, ``throughput_rps``
    and ``config``, and drop rows without duration, throughput or row count.

    Older files carry milliseconds in ``batch_duration``, the rate in
    ``processed_rps``, or no ``config``.
    """
    have = metrics.columns
    missing = F.lit(None).cast("double")
    if "duration_sec" in have:
        duration = to_number(F.col("duration_sec"))
    elif "batch_duration" in have:
        duration = to_number(F.col("batch_duration")) / 1000
    else:
        duration = missing
    rate_name = next((n for n in ("throughput_rows_per_sec", "processed_rps") if n in have), None)
    rate = to_number(F.col(rate_name)) if rate_name else missing
    config = F.col("config") if "config" in have else F.lit("default")
    measured = metrics.withColumns(
        {"duration_sec": duration, "throughput_rps": rate, "config": config}
    )
    return measured.dropna(subset=["duration_sec", "throughput_rps", "rows"])


def with_config_seconds(metrics: DataFrame) -> DataFrame:
    """Parse window and trigger out of the label; drop rows lacking either."""
    return metrics.withColumns(
        {
            "window_seconds": seconds_of(F.col("config"), "window"),
            "trigger_seconds": seconds_of(F.col("config"), "trigger"),
        }
    ).dropna(subset=["window_seconds", "trigger_seconds"])


def drop_warmup(metrics: DataFrame, run: str | None = None) -> DataFrame:
    """Drop the first batch of every (window, trigger) pair.

    Runs of one pair are pooled, so one row goes per pair; name a ``run`` column
    to drop one per run instead.

    The first batch has the smallest whole number, then time; of rows equal in both, any
    one goes. A number or time that is missing comes last, so does a number beyond 2**61.
    Number and time are one wide decimal, whose minimum is hashed and combines on the map
    side: one pass, one exchange of a row per task and pair. The rows are written once, so
    that their ids are the same in both branches, and so are the chosen ids.
    """
    keys = ["window_seconds", "trigger_seconds", *([run] if run else [])]
    kept = materialise(metrics.withColumn("_row", F.monotonically_increasing_id()), "metrics")
    first = kept.groupBy(*keys).agg(F.min_by("_row", _batch_order()).alias("_row")).select("_row")
    return kept.join(materialise(first, "warmup"), "_row", "left_anti").drop("_row")


def _batch_order() -> Column:
    """Batch number, then time, as one number of 126 bits that sorts as they do."""
    number = F.col("batch_id").cast("double")
    whole = F.when(number.between(float(-_LAST_BATCH), float(_LAST_BATCH)), F.floor(number))
    micros = F.unix_micros(F.col("timestamp").try_cast("timestamp"))
    batch = F.coalesce(whole, F.lit(_LAST_BATCH)).cast("decimal(20,0)") + F.lit(_LAST_BATCH)
    time = F.coalesce(micros, F.lit(_LAST_TIME)).cast("decimal(20,0)") + F.lit(_LAST_TIME)
    return batch.cast("decimal(19,0)") * F.lit(2**32).cast("decimal(10,0)") * F.lit(2**32).cast("decimal(10,0)") + time


def steady_state_summary(metrics: DataFrame, run: str | None = None) -> DataFrame:
    """Mean latency and throughput per (window, trigger) without warmup."""
    numeric = metrics.withColumns(
        {
            "duration_sec": to_number(F.col("duration_sec")),
            "throughput_rows_per_sec": to_number(F.col("throughput_rows_per_sec")),
            "batch_id": to_number(F.col("batch_id")),
        }
    )
    return (
        drop_warmup(with_config_seconds(numeric), run)
        .groupBy("window_seconds", "trigger_seconds")
        .agg(
            F.avg("duration_sec").alias("avg_duration_sec"),
            F.avg("throughput_rows_per_sec").alias("avg_throughput"),
            F.count("batch_id").alias("batches"),
        )
        .select(
            "window_seconds",
            "trigger_seconds",
            "batches",
            "avg_duration_sec",
            "avg_throughput",
            short_label(F.col("window_seconds"), F.col("trigger_seconds")).alias("short_label"),
        )
        .orderBy("window_seconds", "trigger_seconds")
    )


def _per_config(metrics: DataFrame) -> GroupedData:
    return metrics.where(F.col("config").isNotNull()).groupBy("config")


def batch_size_by_config(metrics: DataFrame) -> DataFrame:
    return _per_config(metrics).agg(F.avg("rows").alias("avg_rows"))


def latency_jitter(metrics: DataFrame) -> DataFrame:
    """Sample standard deviation of the duration; NULL for a single batch."""
    return _per_config(metrics).agg(F.stddev_samp("duration_sec").alias("jitter_sec"))


def throughput_efficiency(metrics: DataFrame) -> DataFrame:
    """Mean throughput per configuration in percent of the best batch of all.

    The best batch is an uncorrelated scalar subquery over one column, so the
    metrics are neither joined nor sorted.
    """
    best = metrics.agg(F.max("throughput_rps")).scalar()
    return _per_config(metrics.withColumn("share", F.col("throughput_rps") / best * 100)).agg(
        F.avg("share").alias("efficiency")
    )


def latency_histogram(metrics: DataFrame, column: str = "duration_sec", bins: int = 20) -> DataFrame:
    """Counts in ``bins`` equal bins from minimum to maximum, empty ones included.

    Bins are half open except the last; if all values agree, the range is half a
    unit to either side. Columns: ``bin`` (from 0), ``lo``, ``hi``, ``n``.

    The range is read first, as one row; the counts are a second pass over the
    one column.
    """
    low, high = metrics.agg(F.min(column), F.max(column)).first()
    if low is None:
        low, high = 0.0, 1.0
    elif low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins

    def edge(number: Column) -> Column:
        return F.when(number == bins, high).otherwise(low + number * width)

    value = F.col(column)
    guess = F.least(F.floor((value - low) / (high - low) * bins), F.lit(bins - 1))
    # Division may land a value one bin away from the edges it is reported with.
    nudge = F.when(value < edge(F.col("guess")), -1).when(
        (F.col("guess") < bins - 1) & (value >= edge(F.col("guess") + 1)), 1
    )
    counts = (
        metrics.where(value.isNotNull())
        .withColumn("guess", guess)
        .groupBy((F.col("guess") + F.coalesce(nudge, F.lit(0))).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    every_bin = metrics.sparkSession.range(bins).withColumnRenamed("id", "bin")
    # At most one count per bin, so this side is broadcast whatever the input.
    return every_bin.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        edge(F.col("bin")).alias("lo"),
        edge(F.col("bin") + 1).alias("hi"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
    )


def scaling_curve(metrics: DataFrame) -> DataFrame:
    """Row count and duration of every batch."""
    return metrics.select("rows", "duration_sec")
