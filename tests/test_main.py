"""The command line over a small station file, from raw lines to reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadpulse.__main__ import main
from roadpulse.operators.cleaning import prepare
from roadpulse.operators.readings import canonical_readings
from roadpulse.operators.windows import window_aggregate
from roadpulse.sources.files import read_station_files

LINE = "11/06/2006 00:{minute:02d}:00,S1,7,5,S,ML,.452,30,{observed},{flow},.08,64.1,1,2,3,4,5"


def test_from_raw_lines_to_reports(spark, tmp_path, capsys):
    raw = tmp_path / "day.txt"
    raw.write_text(
        "".join(
            LINE.format(minute=minute, observed=100 if minute % 5 else 0, flow=minute) + "\n"
            for minute in range(40)
        )
    )
    main(["convert", str(raw)])
    converted = spark.read.option("header", True).csv(str(tmp_path / "day.csv"))
    assert converted.count() == 40 and len(converted.columns) == 12

    main(["prepare", str(raw)])
    assert "unobserved" in capsys.readouterr().out
    cleaned = str(tmp_path / "day_final.csv")
    assert spark.read.option("header", True).csv(cleaned).count() == 32

    chunks = str(tmp_path / "chunks")
    main(["chunks", cleaned, chunks, "--chunk-size", "10"])
    assert len(list((tmp_path / "chunks").glob("chunk=*/*.csv"))) == 4

    out, metrics = str(tmp_path / "out"), str(tmp_path / "metrics")
    stream = ["stream", "--input-path", f"{chunks}/*", "--output-path", out, "--metrics-path", metrics]
    main([*stream, "--checkpoint-path", str(tmp_path / "c"), "--trigger", "available-now"])
    aggregates = spark.read.parquet(out)
    # The newest window stays open.
    assert aggregates.count() == 31
    assert {row["region"] for row in aggregates.collect()} == {"LA"}

    main(["watch", f"{chunks}/*", "--trigger", "available-now"])
    main(["traffic", out, "--output", str(tmp_path / "traffic")])
    assert spark.read.parquet(str(tmp_path / "traffic" / "peak_congestion")).count() == 5
    main(["system", metrics, "--output", str(tmp_path / "system")])
    assert spark.read.parquet(str(tmp_path / "system" / "latency_histogram")).count() == 20


def test_batch_from_raw_lines(spark, tmp_path):
    raw = tmp_path / "day.txt"
    raw.write_text(
        LINE.format(minute=0, observed=100, flow=12.7) + "\n" + LINE.format(minute=1, observed=0, flow=9) + "\n"
    )
    records = prepare(read_station_files(spark, str(raw)))
    windows = window_aggregate(canonical_readings(records), "5 minutes")
    got = windows.select("region", "avg_speed", "total_vehicles", F.col("window_start").cast("string")).collect()
    assert [tuple(row) for row in got] == [("LA", 64.1, 12, "2006-11-06 00:00:00")]
