"""Inputs of the registered queries, derived from the given tables.

Every row of the source table is used. The rules below only decide which cells
of a record are made unusable; ``oracle.py`` states the same rules in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.functions.cells import ISO_TIME
from roadpulse.functions.labels import config_text
from roadpulse.operators.windows import window_aggregate
from roadpulse.schemas import BASE_COLUMNS, LANE_FIELDS, STATION_TEXT, SWEEP
from roadpulse.storage import materialise

US_TIME = "MM/dd/yyyy HH:mm:ss"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(n: int) -> Column:
    return F.col("event_id") % n == 0


def event_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as canonical readings: type as region, user as road."""
    return _as_readings(table(spark, sf_dir, "events"))


def shipment_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as canonical readings: the larger table."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("ts"),
        F.col("l_returnflag").alias("region"),
        F.col("l_suppkey").cast("string").alias("road_id"),
        F.col("l_quantity").cast("int").alias("vehicle_count"),
        F.col("l_extendedprice").alias("speed"),
    )


def stream_event_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same readings as a stream over the table's own Parquet files."""
    schema = table(spark, sf_dir, "events").schema
    # A glob, as a streaming file source takes a folder or a glob, not one file.
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")
    return _as_readings(events.withColumn("ts", F.col("ts").cast("timestamp")))


def _as_readings(events: DataFrame) -> DataFrame:
    return events.select(
        "ts",
        F.col("event_type").alias("region"),
        F.col("user_id").cast("string").alias("road_id"),
        F.col("value").cast("int").alias("vehicle_count"),
        F.col("value").alias("speed"),
    )


def station_records(
    spark: SparkSession, sf_dir: str, time_pattern: str = ISO_TIME, spoil_times: bool = True
) -> DataFrame:
    """``events`` as station records with unusable cells, plus ``event_id`` and ``ts``."""
    time = F.date_format("ts", time_pattern)
    value = F.col("value").cast("string")
    direction = F.element_at(
        F.array(*map(F.lit, "NSEW")), (F.col("user_id") % 4 + 1).cast("int")
    )
    lane_type = F.element_at(
        F.array(*map(F.lit, ["ML", "OR", "FR"])), (F.col("event_id") % 3 + 1).cast("int")
    )
    cells = {
        "Timestamp": F.when(_every(19), "bad").otherwise(time) if spoil_times else time,
        "Station": F.col("user_id").cast("string"),
        "District": F.when(_every(31), F.lit(None))
        .when(F.col("event_type") == "view", "7")
        .when(F.col("event_type") == "click", "7.0")
        .otherwise((F.col("event_id") % 12).cast("string")),
        "Freeway #": (F.col("user_id") % 400).cast("string"),
        "Direction of Travel": direction,
        "Lane Type": lane_type,
        "Station Length": F.lit("0.5"),
        "Samples": (F.col("event_id") % 60).cast("string"),
        "% Observed": F.when(_every(17), F.lit(None)).when(_every(7), "0").otherwise("100"),
        "Total Flow": F.when(_every(10), "").when(_every(11), "   ").otherwise(value),
        "Avg Occupancy": F.lit("0.125"),
        "Avg Speed": F.when(_every(13), "NA").otherwise(value),
        "Region": F.col("event_type"),
    }
    return table(spark, sf_dir, "events").select(
        "event_id", "ts", *[cell.alias(name) for name, cell in cells.items()]
    )


def station_cells(records: DataFrame) -> DataFrame:
    """Only the file's thirteen columns."""
    return records.select(*[F.col(field.name) for field in STATION_TEXT])


def lane_cells(records: DataFrame) -> list[Column]:
    """Two lanes of detail, as columns named like those of a wide station file."""
    return [
        F.concat_ws("-", F.lit(f"{lane}"), F.col("Samples")).alias(f"Lane {lane} {field}")
        for lane in (1, 2)
        for field in LANE_FIELDS
    ] + [F.col("Samples").alias("Extra_22")]


def station_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headerless raw lines of zero to two lanes; some have a cell too many, some
    lack their last two base cells.
    """
    records = station_records(spark, sf_dir, US_TIME, spoil_times=False)
    cells = [F.coalesce(F.col(name), F.lit("")) for name in BASE_COLUMNS]
    lanes = F.array_repeat(F.lit("1"), (F.col("event_id") % 3 * len(LANE_FIELDS)).cast("int"))
    whole = F.concat(F.array(*cells), lanes)
    line = (
        F.when(_every(41), F.array(*cells[:-2]))
        .when(_every(37), F.concat(whole, F.array(F.lit("x"))))
        .otherwise(whole)
    )
    return records.select(F.array_join(line, ",").alias("line"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station records as messages; some are not JSON, some are empty."""
    records = station_records(spark, sf_dir)
    body = F.to_json(F.struct(*[F.col(field.name) for field in STATION_TEXT]))
    value = F.when(_every(29), F.lit(None)).when(_every(23), "not json").otherwise(body)
    return records.select(
        value.cast("binary").alias("value"), F.col("ts").cast("timestamp").alias("timestamp")
    )


def hourly_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-hour aggregates of ``events`` as the written table that reports read."""
    return materialise(window_aggregate(event_readings(spark, sf_dir), "1 hour"), "aggregates")


def batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics rows: a hundred events make a batch, the six labels take turns."""
    labels = F.array(*[F.lit(config_text("file", window, trigger)) for window, trigger in SWEEP])
    batch = F.expr("event_id div 100")
    per_batch = (
        table(spark, sf_dir, "events")
        .groupBy(batch.alias("batch_id"))
        .agg(
            F.date_format(F.min("ts"), ISO_TIME).alias("timestamp"),
            F.count(F.lit(1)).alias("rows"),
            (F.sum("value") / 1000).alias("duration_sec"),
        )
    )
    return per_batch.select(
        "timestamp",
        "batch_id",
        "rows",
        "duration_sec",
        (F.col("rows") / F.col("duration_sec")).alias("throughput_rows_per_sec"),
        F.element_at(labels, (F.col("batch_id") % len(SWEEP) + 1).cast("int")).alias("config"),
    )
