"""Station records to canonical readings (ts, region, road_id, vehicle_count, speed)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.cells import first_filled, read_time, region_of, to_number, to_whole
from roadpulse.schemas import FLOW_NAMES, SPEED_NAMES

INGEST_TIME = "kafka_ts"


def canonical_readings(records: DataFrame, event_time: str = "payload") -> DataFrame:
    """One projection for both feeds, batch or streaming.

    ``event_time`` is ``"payload"`` for the record's own ``Timestamp`` or
    ``"ingest"`` for the broker's time. Records without an event time belong to
    no window and are left out.
    """
    if event_time == "payload":
        moment = read_time(F.col("Timestamp"))
    elif event_time == "ingest":
        moment = F.col(INGEST_TIME)
    else:
        raise ValueError(f"event_time must be 'payload' or 'ingest', not {event_time!r}")
    return records.select(
        moment.alias("ts"),
        region_of(F.col("District")).alias("region"),
        F.col("Station").alias("road_id"),
        to_whole(first_filled(records, FLOW_NAMES)).alias("vehicle_count"),
        to_number(first_filled(records, SPEED_NAMES)).alias("speed"),
    ).where(F.col("ts").isNotNull())


def timed_records(records: DataFrame) -> DataFrame:
    """Typed station records with their event time as ``ts``."""
    return records.withColumn("ts", read_time(F.col("Timestamp")))


def completeness() -> list[Column]:
    """Counts of usable cells, for one ``agg`` or one ``observe`` pass."""
    return [
        F.count(F.lit(1)).alias("total"),
        F.count("ts").alias("has_ts"),
        F.count("speed").alias("has_speed"),
        F.count("vehicle_count").alias("has_count"),
    ]


def quality_counts(readings: DataFrame) -> DataFrame:
    """Completeness counts as one row, or no row for no readings."""
    return readings.agg(*completeness()).where(F.col("total") > 0)
