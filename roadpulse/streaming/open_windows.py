"""What a streaming job still holds: open windows, and the readings that came too late.

Append mode shows a window once it is closed. The windows still open are in the state
store, whose committed version these functions read beside the running or stopped query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.functions.measures import congestion
from roadpulse.sources.files import read_aggregates, read_metrics

# The state's buffers in the order of the aggregate's measures: an average keeps a sum and a count.
_BUFFERS = ["speed_sum double", "speeds bigint", "total_vehicles bigint"]


def open_windows(spark: SparkSession, checkpoint: str, counted: bool = False) -> DataFrame:
    """The windows a job has not emitted, as its last committed batch left them.

    Columns as in ``window_aggregate``; ``counted`` says that the job counts readings.
    One row per open window and region, read by the tasks where the state is.
    """
    state = spark.read.format("statestore").load(checkpoint)
    fields = ", ".join(f.replace(" ", ": ") for f in [*_BUFFERS, *["readings bigint"] * counted])
    held = state.select("key.*", F.col("value").cast(f"struct<{fields}>").alias("held"))
    speed = F.when(F.col("held.speeds") > 0, F.col("held.speed_sum") / F.col("held.speeds"))
    return held.select(
        "region",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        speed.alias("avg_speed"),
        "held.total_vehicles",
        congestion(F.col("held.total_vehicles"), speed).alias("congestion_index"),
        *["held.readings"] * counted,
    )


def current_windows(spark: SparkSession, output: str, checkpoint: str, counted: bool = False) -> DataFrame:
    """Emitted and open windows together, with ``is_open``: all that has been read and was not late."""
    emitted = read_aggregates(spark, output).withColumn("is_open", F.lit(False))
    return emitted.unionByName(open_windows(spark, checkpoint, counted).withColumn("is_open", F.lit(True)))


def readings_ledger(spark: SparkSession, output: str, checkpoint: str, metrics: str) -> DataFrame:
    """One row: readings that ``arrived``, those in ``emitted`` windows, in ``open_now`` ones, and ``late``.

    For a stopped job that counts readings. Every reading with an event time is in one
    window or was dropped as late, so the late ones are what is left over: exact, whereas
    Spark's own number counts rows after map-side combining.
    """
    arrived = read_metrics(spark, metrics).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("arrived"))
    placed = current_windows(spark, output, checkpoint, counted=True).agg(
        *[
            F.coalesce(F.sum(F.when(F.col("is_open") == is_open, F.col("readings"))), F.lit(0)).alias(name)
            for name, is_open in (("emitted", False), ("open_now", True))
        ]
    )
    # Two tables of one row.
    return arrived.crossJoin(placed).withColumn("late", F.expr("arrived - emitted - open_now"))
