"""Console output for development."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from roadpulse.sinks.files import with_trigger


def console_sink(
    stream: DataFrame, trigger: str, mode: str = "append", rows: int = 200
) -> DataStreamWriter:
    writer = (
        stream.writeStream.format("console")
        .outputMode(mode)
        .option("truncate", False)
        .option("numRows", rows)
    )
    return with_trigger(writer, trigger)


def print_whole(table: DataFrame) -> None:
    """Print all rows of a table that has one per configuration."""
    table.show(table.count(), truncate=False)
