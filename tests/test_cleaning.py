from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from roadpulse.operators import cleaning
from roadpulse.operators.payloads import decode_payload, encode_payload, payload_key_profile
from roadpulse.operators.readings import canonical_readings, quality_counts
from roadpulse.schemas import BASE_COLUMNS, STATION_TEXT
from roadpulse.sinks.files import default_csv_path, write_csv
from roadpulse.sources.files import (
    has_header,
    read_metrics,
    read_early_metrics,
    read_station_csv,
    read_station_files,
    read_station_text,
)

SCHEMA = "id int, `% Observed` string, `Total Flow` string, `Avg Speed` string"
RECORDS = [
    (1, "0", "5", "60"),
    (2, None, "5", "60"),
    (3, "5", "5", "60"),
    (4, "0.0", "", "NA"),
    (5, "80", "", "NA"),
    (6, "80", "5", "NA"),
    (7, "x", "5", "60"),
]


def records(spark):
    return spark.createDataFrame(RECORDS, SCHEMA)


def ids(frame):
    return sorted(row["id"] for row in frame.collect())


def test_unknown_share_is_kept(spark):
    assert ids(cleaning.drop_unobserved(records(spark))) == [2, 3, 5, 6, 7]


def test_missing_measures_are_dropped(spark):
    assert ids(cleaning.drop_missing(records(spark), "Total Flow")) == [1, 2, 3, 6, 7]
    assert ids(cleaning.drop_missing(records(spark), "Avg Speed")) == [1, 2, 3, 7]


def test_audit_counts_the_first_failing_rule(spark):
    lines = [tuple(row) for row in cleaning.cleaning_audit(records(spark)).collect()]
    assert lines == [
        (1, "unobserved", 2, 28.6, 5),
        (2, "no flow", 1, 14.3, 4),
        (3, "no speed", 1, 14.3, 3),
        (4, "total", 4, 57.1, 3),
    ]


def test_audit_agrees_with_prepare(spark):
    kept = cleaning.prepare(records(spark)).count()
    assert cleaning.cleaning_audit(records(spark)).where("rule = 'total'").first()["rows_remaining"] == kept


def test_audit_of_nothing(spark):
    last = cleaning.cleaning_audit(records(spark).limit(0)).where("rule = 'total'").first()
    assert (last["rows_removed"], last["pct_of_input"], last["rows_remaining"]) == (0, None, 0)


def test_prepare_leaves_out_steps_without_a_column(spark):
    frame = spark.createDataFrame([("a", "x")], "Station string, `Lane 1 Flow` string")
    prepared = cleaning.prepare(frame, region_mode="district")
    assert prepared.columns == ["Station", "region"]
    assert prepared.collect() == [("a", "LA")]


def test_base_columns(spark):
    names = [*BASE_COLUMNS, "Lane 1 Flow", "Lane 2 Samples", "Extra_22", "note"]
    wide = spark.range(1).select(*[F.lit("v").alias(name) for name in names])
    assert cleaning.keep_base_columns(wide).columns == BASE_COLUMNS
    assert cleaning.lane_columns(wide) == ["Lane 1 Flow", "Lane 2 Samples", "Extra_22"]


LINE = "11/06/2006 00:05:00,715898,7,5,S,ML,.452,30,100,312,.08,64.1"


def test_headerless_lines_of_any_width(spark, tmp_path):
    (tmp_path / "lines.txt").write_text(
        "\n".join([LINE, LINE + ",1,2,3,4,5", LINE + ",1,2,3,4,5,6", LINE.rsplit(",", 2)[0]]) + "\n"
    )
    assert not has_header(spark, str(tmp_path))
    got = read_station_files(spark, str(tmp_path))
    assert got.columns == BASE_COLUMNS
    speeds = sorted(str(row["Avg Speed"]) for row in got.collect())
    assert speeds == ["64.1", "64.1", "64.1", "None"]


def test_named_columns_are_all_kept(spark, tmp_path):
    (tmp_path / "named.csv").write_text(f"{','.join(BASE_COLUMNS)},Lane 1 Flow\n{LINE},9\n")
    assert has_header(spark, str(tmp_path))
    got = read_station_files(spark, str(tmp_path))
    assert got.columns == [*BASE_COLUMNS, "Lane 1 Flow"]
    assert got.first()["Lane 1 Flow"] == "9"


def test_from_raw_lines_to_clean_csv(spark, tmp_path):
    raw = tmp_path / "raw.txt"
    raw.write_text(LINE + "\n" + LINE.replace(",100,312", ",0,312") + "\n")
    prepared = cleaning.prepare(read_station_text(spark, str(raw)))
    out = str(tmp_path / "out")
    write_csv(prepared, out)
    row = read_station_csv(spark, out).collect()
    assert len(row) == 1
    assert row[0]["Timestamp"] == "2006-11-06 00:05:00"
    assert (row[0]["Total Flow"], row[0]["region"]) == ("312.0", "LA")


def test_default_csv_path():
    assert default_csv_path("/data/day.txt") == "/data/day.csv"
    assert default_csv_path("day.csv", "_final") == "day_final.csv"
    assert default_csv_path("/data.d/day", "_final") == "/data.d/day_final.csv"


def station(**cells):
    return tuple(cells.get(field.name) for field in STATION_TEXT)


def test_canonical_readings(spark):
    frame = spark.createDataFrame(
        [
            station(Timestamp="2006-11-06 00:05:00", Station="1", District="7", **{"Total Flow": "12.7", "Avg Speed": " "}),
            station(Timestamp="2006-11-06 00:05:00", Station="2", **{"Avg Speed": "NaN"}),
            station(Timestamp="soon", Station="3", District="7"),
        ],
        STATION_TEXT,
    )
    got = canonical_readings(frame)
    time = dt.datetime(2006, 11, 6, 0, 5)
    rows = got.withColumn("ts", F.col("ts").cast("timestamp_ntz")).collect()
    assert [tuple(row) for row in rows] == [(time, "LA", "1", 12, None), (time, None, "2", None, None)]
    assert tuple(quality_counts(got).first()) == (2, 2, 0, 1)
    assert quality_counts(got.where("false")).collect() == []


def test_sample_layout_is_bound_by_position(spark, tmp_path):
    """A five-column file under the thirteen-column schema has no measures."""
    (tmp_path / "s.csv").write_text(
        "timestamp,region,road_id,vehicle_count,speed\n2025-01-01 08:00:00,North,R1,10,40.5\n"
    )
    rows = spark.read.schema(STATION_TEXT).option("header", True).csv(str(tmp_path))
    reading = canonical_readings(rows).first()
    assert (reading["region"], reading["road_id"]) == ("R1", "North")
    assert reading["vehicle_count"] is None and reading["speed"] is None


def messages(spark, texts):
    frame = spark.createDataFrame([(text,) for text in texts], "value string")
    return frame.select(F.col("value").cast("binary").alias("value"), F.lit("2024-01-01").cast("timestamp").alias("timestamp"))


def test_decode(spark):
    frame = messages(spark, ['{"Station": "1", "Total Flow": 5.5, "region": "x"}', "not json", None, "{}"])
    got = [(row["Station"], row["Total Flow"], row["Region"]) for row in decode_payload(frame).collect()]
    assert got == [("1", "5.5", None), (None, None, None), (None, None, None)]
    strict = decode_payload(frame, drop_malformed=True)
    assert [row["Station"] for row in strict.collect()] == ["1", None]
    assert strict.columns == [*STATION_TEXT.names, "kafka_ts"]


def test_encode_then_decode(spark):
    frame = spark.createDataFrame([station(Station='a "quoted" \\ one', District="7")], STATION_TEXT)
    encoded = encode_payload(frame)
    back = decode_payload(messages(spark, [encoded.first()["value"]])).first()
    assert (back["Station"], back["District"], back["Samples"]) == ('a "quoted" \\ one', "7", "")


def test_key_profile_covers_every_message(spark):
    frame = messages(spark, ['{"a": 1}'] * 5 + ['{"a": 1, "b": {"c": 2}}', "[1]", "x", None])
    got = {row["key"]: row["messages"] for row in payload_key_profile(frame).collect()}
    assert got == {"a": 6, "b": 1}


def test_metrics_files(spark, tmp_path):
    v2 = tmp_path / "v2.csv"
    v2.write_text(
        "timestamp,batch_id,rows,duration_sec,throughput_rows_per_sec,config\n"
        "2025-11-11 02:32:46,0,4,0.5,8.0,file|window=5 seconds|trigger=2 seconds\n"
        "bad,1,x,,nan,\n"
    )
    rows = read_metrics(spark, str(v2)).orderBy("batch_id").collect()
    assert (rows[0]["rows"], rows[0]["duration_sec"]) == (4, 0.5)
    assert tuple(rows[1])[2:] == (None, None, None, None) and rows[1]["timestamp"] is None
    v1 = tmp_path / "v1.csv"
    v1.write_text("2025-11-11 02:32:46,0,4\n2025-11-11 02:32:52,1,0\n")
    early = read_early_metrics(spark, str(v1)).orderBy("batch_id").collect()
    assert [row["rows"] for row in early] == [4, 0]
    assert early[0]["timestamp"] == dt.datetime(2025, 11, 11, 2, 32, 46)
