from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.functions import cells, labels, lanes
from roadpulse.functions.measures import congestion
from roadpulse.plans.catalog import steady
from roadpulse.schemas import (
    BASE_COLUMNS,
    FLOW_NAMES,
    STATION_TEXT,
    STATION_TYPED,
    load_schema,
    schema_from_description,
)


def values(spark, rows, expression, schema="x string"):
    frame = spark.createDataFrame([(row,) for row in rows], schema)
    return [row[0] for row in frame.select(expression).collect()]


TEXTS = ["12", "12.0", "12.7", " ", "", "NaN", "NA", None, "-3.9", "1e12", " 8 "]


def test_whole_numbers(spark):
    want = [12, 12, 12, None, None, None, None, None, -3, None, 8]
    assert values(spark, TEXTS, cells.to_whole(F.col("x"))) == want


def test_numbers(spark):
    want = [12.0, 12.0, 12.7, None, None, None, None, None, -3.9, 1e12, 8.0]
    assert values(spark, TEXTS, cells.to_number(F.col("x"))) == want


def test_blank_to_null_keeps_other_text(spark):
    rows = ["", "   ", None, " a ", "0"]
    assert values(spark, rows, cells.blank_to_null(F.col("x"))) == [None, None, None, " a ", "0"]


def test_first_filled(spark):
    frame = spark.createDataFrame(
        [("", "5", "6"), ("4", "5", None), (None, " ", None)], "`Total Flow` string, Flow string, z string"
    )
    assert [r[0] for r in frame.select(cells.first_filled(frame, FLOW_NAMES)).collect()] == ["5", "4", None]
    unit = spark.createDataFrame([("", "3")], "Flow string, `Total Flow (Veh/5min)` string")
    assert unit.select(cells.first_filled(unit, FLOW_NAMES)).first()[0] == "3"
    nothing = frame.select(cells.first_filled(frame, ["absent"]).alias("n"))
    assert nothing.schema["n"].dataType == T.StringType()
    assert {r[0] for r in nothing.collect()} == {None}


def test_region(spark):
    rows = ["7", "7.0", " 7", "8", "07", "x", "", None]
    want = ["LA", "LA", "LA", "8", "LA", "x", "", None]
    assert values(spark, rows, cells.region_of(F.col("x"))) == want


TIMES = [
    "2006-11-06 00:05:00",
    "2024-02-29 23:59:59",
    "11/06/2006 00:05:00",
    "",
    None,
    "2006-13-01 00:00:00",
    "2023-02-29 00:00:00",
    "2006-11-06 24:00:00",
    "2006-11-06 00:00:60",
    "2006-11-06",
    "2006-11-06T00:05:00",
    "2006-11-06 00:05:00Z",
    "2006-11-06 00:05:00.5",
    "2006-11-6 0:05:00",
    " 2006-11-06 00:05:00",
    "2006-11-06 00:05:00\n",
    "0000-01-01 00:00:00",
    "0001-01-01 00:00:00",
]


def test_event_time(spark):
    got = values(spark, TIMES, cells.read_time(F.col("x")).cast("string"))
    assert got[:3] == ["2006-11-06 00:05:00", "2024-02-29 23:59:59", None]
    # Spark's pattern parser accepts the same texts and reads them alike.
    pattern = F.try_to_timestamp(F.col("x"), F.lit(cells.ISO_TIME)).cast("string")
    assert got == values(spark, TIMES, pattern)


def test_station_time(spark):
    rows = ["11/06/2006 00:05:00", "1/6/2006 0:05:00", "2006-11-06 00:05:00", "bad", None]
    want = ["2006-11-06 00:05:00", "2006-01-06 00:05:00", None, None, None]
    assert values(spark, rows, cells.station_time_to_iso(F.col("x"))) == want


def test_congestion(spark):
    frame = spark.createDataFrame(
        [(10, 4.0), (10, 0.0), (10, None), (None, 4.0), (1, 8.0), (1, 3.0)], "n bigint, v double"
    )
    got = [r[0] for r in frame.select(congestion(F.col("n"), F.col("v"))).collect()]
    assert got == [2.5, None, None, None, 0.13, 0.33]


def test_comparison_ignores_summation_noise(spark):
    rows = [17.525, 17.524999999999999, 17.525000000000002, -0.005, float("inf"), None, 1e20]
    got = values(spark, rows, steady(F.col("x"), 2), "x double")
    assert got == [17.53, 17.53, 17.53, -0.01, float("inf"), None, 1e20]


def test_congestion_is_rounded_as_it_stands(spark):
    """No value is moved before it is rounded."""
    rows = [1.00499999999996, 2.67499999999999, 0.125]
    frame = spark.createDataFrame([(r,) for r in rows], "n double")
    got = [r[0] for r in frame.select(congestion(F.col("n"), F.lit(1.0))).collect()]
    assert got == [1.0, 2.67, 0.13]


LABELS = [
    "file|window=5 seconds|trigger=2 seconds",
    "kafka | window= 10 seconds | trigger=20 seconds",
    "file|window=1 minute|trigger=available-now",
    "file|window=5s|trigger=2",
    "default",
    None,
]


def test_label_parts(spark):
    assert values(spark, LABELS, labels.seconds_of(F.col("x"), "window")) == [5, 10, 1, None, None, None]
    assert values(spark, LABELS, labels.seconds_of(F.col("x"), "trigger")) == [2, 20, None, 2, None, None]


def test_label_round_trip(spark):
    text = labels.config_text("file", "5 seconds", "20 seconds")
    column = labels.config_label(F.lit("file"), F.lit("5 seconds"), F.lit("20 seconds"))
    assert values(spark, ["x"], column) == [text]
    assert values(spark, [text], labels.seconds_of(F.col("x"), "trigger")) == [20]
    assert values(spark, ["x"], labels.short_label(F.lit(5), F.lit(20))) == ["W5–T20"]


@pytest.mark.parametrize(
    ("width", "lane_total", "tail"),
    [
        (0, 0, []),
        (10, 0, BASE_COLUMNS[8:10]),
        (12, 0, ["Avg Speed"]),
        (13, 0, ["Extra_12"]),
        (17, 1, ["Lane 1 Avg Speed", "Lane 1 Observed"]),
        (24, 2, ["Lane 2 Observed", "Extra_22", "Extra_23"]),
    ],
)
def test_layout_names(spark, width, lane_total, tail):
    frame = spark.createDataFrame([(width,)], "w int")
    count, names = frame.select(lanes.lane_count(F.col("w")), lanes.layout_names(F.col("w"))).first()
    assert count == lane_total
    assert len(names) == width
    assert names[:12] == BASE_COLUMNS[:width]
    assert names[len(names) - len(tail) :] == tail


def test_schema_description(spark, tmp_path):
    file = tmp_path / "schema.json"
    file.write_text(
        '{"fields": [{"name": "road_id", "type": "String"}, {"name": "n", "type": "integer"},'
        ' {"name": "speed", "type": "double"}]}'
    )
    want = T.StructType().add("road_id", "string").add("n", "integer").add("speed", "double")
    assert load_schema(spark, str(file)) == want
    with pytest.raises(ValueError, match="unknown type 'long'"):
        schema_from_description({"fields": [{"name": "n", "type": "long"}]})


def test_station_schemas():
    assert len(STATION_TEXT) == len(STATION_TYPED) == 13
    assert {field.dataType for field in STATION_TEXT} == {T.StringType()}
    assert STATION_TYPED["Samples"].dataType == T.IntegerType()
    assert STATION_TYPED["Total Flow"].dataType == T.DoubleType()
