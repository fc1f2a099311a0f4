"""Column names and types of the tables the engine reads and writes."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import SparkSession
from pyspark.sql import types as T

# The file layout of the station feed, the names other producers
# use for the two measures, the layout of the batch metrics file, and the six
# configurations of the published sweep.
BASE_COLUMNS = [
    "Timestamp",
    "Station",
    "District",
    "Freeway #",
    "Direction of Travel",
    "Lane Type",
    "Station Length",
    "Samples",
    "% Observed",
    "Total Flow",
    "Avg Occupancy",
    "Avg Speed",
]
LANE_FIELDS = ["Samples", "Flow", "Avg Occ", "Avg Speed", "Observed"]
FLOW_NAMES = [
    "Total Flow",
    "Total_Flow",
    "TotalFlow",
    "Flow",
    "Total Flow (Veh/5m)",
    "Total Flow (Veh/5min)",
]
SPEED_NAMES = ["Avg Speed", "Avg_Speed", "Average Speed", "Speed", "Speed (mph)"]
EARLY_METRICS_COLUMNS = ["timestamp", "batch_id", "rows"]
HOME_DISTRICT = 7
HOME_REGION = "LA"
SWEEP = [
    ("5 seconds", "2 seconds"),
    ("5 seconds", "5 seconds"),
    ("5 seconds", "20 seconds"),
    ("10 seconds", "2 seconds"),
    ("10 seconds", "5 seconds"),
    ("10 seconds", "20 seconds"),
]


def _strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


# Everything arrives as text, so the CSV and the JSON feed share one schema and
# a bad cell becomes NULL in a later cast instead of spoiling its record.
STATION_TEXT = _strings([*BASE_COLUMNS, "Region"])
STATION_LINE = _strings(BASE_COLUMNS)
# The cells a reading is made of when the broker gives its time.
STATION_READING = _strings(["Station", "District", "Total Flow", "Avg Speed"])

_TYPED = {
    "District": T.IntegerType(),
    "Freeway #": T.IntegerType(),
    "Station Length": T.DoubleType(),
    "Samples": T.IntegerType(),
    "% Observed": T.DoubleType(),
    "Total Flow": T.DoubleType(),
    "Avg Occupancy": T.DoubleType(),
    "Avg Speed": T.DoubleType(),
}
STATION_TYPED = T.StructType(
    [
        T.StructField(name, _TYPED.get(name, T.StringType()))
        for name in [*BASE_COLUMNS, "region"]
    ]
)

EARLY_METRICS = _strings(EARLY_METRICS_COLUMNS)

_DESCRIBED_TYPES = {
    "string": T.StringType(),
    "integer": T.IntegerType(),
    "double": T.DoubleType(),
}


def schema_from_description(description: Mapping) -> T.StructType:
    """Build a schema from ``{"fields": [{"name": ..., "type": ...}, ...]}``.

    An unknown type name is an error: a silently reused type would shift the
    meaning of a column.
    """
    fields = []
    for field in description["fields"]:
        kind = field["type"].lower()
        if kind not in _DESCRIBED_TYPES:
            raise ValueError(f"unknown type {field['type']!r} for column {field['name']!r}")
        fields.append(T.StructField(field["name"], _DESCRIBED_TYPES[kind]))
    return T.StructType(fields)


def load_schema(spark: SparkSession, path: str) -> T.StructType:
    """Read a schema description through Spark, so any Hadoop path works."""
    text = spark.read.text(path, wholetext=True).first()["value"]
    return schema_from_description(json.loads(text))
