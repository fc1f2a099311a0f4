"""Tumbling-window aggregates per region.

Both aggregates combine on the map side first, so a region that holds most of
the readings still sends one row per task and window through the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.measures import congestion


def _per_window(rows: DataFrame, width: str, *measures: Column) -> DataFrame:
    """``measures`` by region and window, with the window's start and end.

    A stream must group by the window itself, as its watermark hangs on that
    column. A batch groups by the start alone: the narrower key is cheaper to
    hash and to shuffle. The end, the same for a whole group, comes along as a
    maximum; deriving it afterwards would have Catalyst push a second NULL check
    of the start below the aggregate.
    """
    span = F.window("ts", width)
    if rows.isStreaming:
        grouped = rows.groupBy(span.alias("span"), "region").agg(*measures)
        return grouped.withColumns(
            {"window_start": F.col("span.start"), "window_end": F.col("span.end")}
        )
    return rows.groupBy(span.getField("start").alias("window_start"), "region").agg(
        F.max(span.getField("end")).alias("window_end"), *measures
    )


def window_aggregate(readings: DataFrame, width: str, counted: bool = False) -> DataFrame:
    """Average speed, vehicles and congestion per window and region.

    Works on a batch and, behind a watermark, on a stream. NULL measures are
    ignored; readings without a region form a group of their own. ``counted`` adds
    ``readings``, how many there are.
    """
    return _per_window(
        readings,
        width,
        F.avg("speed").alias("avg_speed"),
        F.sum("vehicle_count").alias("total_vehicles"),
        *[F.count(F.lit(1)).alias("readings")] * counted,
    ).select(
        "region",
        "window_start",
        "window_end",
        "avg_speed",
        "total_vehicles",
        congestion(F.col("total_vehicles"), F.col("avg_speed")).alias("congestion_index"),
        *["readings"] * counted,
    )


def typed_window_aggregate(records: DataFrame, width: str) -> DataFrame:
    """The rounded variant over typed station records with an event time ``ts``."""
    return _per_window(
        records,
        width,
        F.round(F.avg("Avg Speed"), 2).alias("avg_speed"),
        F.round(F.sum("Total Flow"), 2).alias("total_vehicles"),
    ).select("region", "window_start", "window_end", "avg_speed", "total_vehicles")
