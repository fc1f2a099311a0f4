"""Nothing is lost, doubled, hidden or bound to the wrong name."""

from __future__ import annotations

import gzip
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from roadpulse.__main__ import job_params, main, parse
from roadpulse.operators import batch_metrics as stats
from roadpulse.operators import chunks, trends
from roadpulse.plans import feeds
from roadpulse.plans.reports import system_tables
from roadpulse.sinks import files as sinks
from roadpulse.sinks import kafka
from roadpulse.sinks.console import print_whole
from roadpulse.sources import files as sources
from roadpulse.storage import clean, fresh_path, materialise, shared_folder
from roadpulse.streaming import job
from roadpulse.streaming.progress import METRICS_TABLE, MetricsListener

FIXED = Path("/root/testdata/sf0.001")
KEYS = ["window_start", "region"]


# --- names of CSV columns ---------------------------------------------------------


def as_rows(table, *names):
    return sorted(tuple(row[name] for name in names) for row in table.collect())


def test_each_file_is_read_by_its_own_header(spark, tmp_path):
    folder = tmp_path / "a b{1}"
    folder.mkdir()
    (folder / "a.csv").write_text("Timestamp,Station\n2024-01-01,S1\n")
    (folder / "b%20.csv").write_text("Station,Timestamp\nS2,2024-01-02\n")
    (folder / "c.csv").write_text("\n\nStation,Region,Timestamp\nS3,LA,2024-01-03\n")
    (folder / "d.csv").write_text("Station,Timestamp\nS4,2024-01-04\n")
    (folder / "e.csv").write_text("\n")
    with gzip.open(folder / "f.csv.gz", "wt") as packed:
        packed.write("Region,Station\nSD,S6\n")
    escaped = str(folder).replace("{", "\\{").replace("}", "\\}")
    table = sources.read_station_csv(spark, escaped)
    assert sorted(map(str, table.select("Station", "Timestamp", "Region").collect())) == sorted(
        f"Row(Station='S{n}', Timestamp={t!r}, Region={r!r})"
        for n, t, r in [
            (1, "2024-01-01", None),
            (2, "2024-01-02", None),
            (3, "2024-01-03", "LA"),
            (4, "2024-01-04", None),
            (6, None, "SD"),
        ]
    )


def test_a_folder_of_layouts_prunes_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Timestamp,Station\n2024-01-01,S1\n")
    (tmp_path / "b.csv").write_text("Station,Region,Timestamp\nS2,LA,2024-01-02\n")
    plan = sources.read_station_csv(spark, str(tmp_path)).select("Station")._jdf.queryExecution().toString()
    assert plan.count("ReadSchema: struct<Station:string>") == 2 and "Exchange" not in plan


def test_folders_named_by_a_key_stay_columns(spark, tmp_path):
    for number, text in enumerate(["x,y\n1,2\n", "y,x\n3,4\n"]):
        (tmp_path / f"part={number}").mkdir()
        (tmp_path / f"part={number}" / "a.csv").write_text(text)
    assert as_rows(sources.read_named_csv(spark, str(tmp_path)), "x", "y", "part") == [("1", "2", 0), ("4", "3", 1)]


def test_metrics_of_several_layouts(spark, tmp_path):
    (tmp_path / "new.csv").write_text(
        "timestamp,batch_id,rows,duration_sec,throughput_rows_per_sec,config\n2024-01-01 00:00:00,1,10,0.5,20,c\n"
    )
    (tmp_path / "old.csv").write_text("timestamp,batch_id,rows,batch_duration,processed_rps\n2024-01-01 00:00:00,2,30,1500,20\n")
    got = stats.normalise_metrics(sources.read_metrics(spark, str(tmp_path)))
    assert as_rows(got, "batch_id", "duration_sec", "throughput_rps", "config") == [(1, 0.5, 20.0, "c"), (2, 1.5, 20.0, "default")]


def test_equal_headers_are_read(spark, tmp_path):
    for name in "ab":
        (tmp_path / f"{name}.csv").write_text(f"Timestamp,Station\n2024-01-01,{name}\n")
    assert sources.read_station_csv(spark, str(tmp_path)).count() == 2


def test_blank_first_line_is_no_header(spark, tmp_path):
    file = tmp_path / "day.txt"
    file.write_text("\n11/06/2006 00:00:00,S1\n11/06/2006 00:05:00,S2\n")
    assert not sources.has_header(spark, str(file))
    assert sources.read_station_files(spark, str(file)).count() == 2


@pytest.mark.parametrize("first", ["a", "b"])
def test_mixed_folder_is_read_file_by_file(spark, tmp_path, first):
    named, unnamed = ("a", "b") if first == "a" else ("b", "a")
    (tmp_path / f"{named}.csv").write_text("Station,Timestamp,Region\nS1,2024-01-01,LA\n")
    (tmp_path / f"{unnamed}.csv").write_text("\n2024-01-02,S2\n2024-01-03,S3,7\n")
    assert not sources.has_header(spark, str(tmp_path))
    table = sources.read_station_files(spark, str(tmp_path))
    assert as_rows(table, "Station", "Timestamp") == [("S1", "2024-01-01"), ("S2", "2024-01-02"), ("S3", "2024-01-03")]
    assert as_rows(table.na.fill("-"), "Region", "District") == [("-", "-"), ("-", "7"), ("LA", "-")]


# --- batch metrics ----------------------------------------------------------------


def test_durations_have_no_size_limit(spark, tmp_path):
    events = spark.read.parquet(str(FIXED / "events.parquet")).limit(150)
    events.withColumn("value", F.lit(1234567.5)).write.parquet(str(tmp_path / "events.parquet"))
    rows = feeds.batch_metrics(spark, str(tmp_path)).collect()
    total = sum(r["duration_sec"] for r in rows)
    assert total == pytest.approx(150 * 1234.5675)


def a_row(batch: int, rows: int, query: str = "q") -> tuple:
    return ("2024-01-01 00:00:00", batch, rows, 0.5, 2.0 * rows, "c", "run", rows, rows, 0, query)


def test_metrics_are_written_once_per_batch(spark, tmp_path):
    path = str(tmp_path / "metrics")
    for again in range(2):  # a restart repeats batch 1 under another run
        listener = MetricsListener(spark, "name", "c", path)
        listener._rows = [a_row(b, 10 * b + again) for b in range(again, 3)]
        listener.flush()
        listener.flush(last=True)
    got = sources.read_metrics(spark, path).select("batch_id", "rows").collect()
    assert sorted(map(tuple, got)) == [(0, 0), (1, 11), (2, 21)]


def test_rows_that_cannot_be_written_are_an_error(spark, tmp_path):
    (tmp_path / "taken").write_text("a file where a folder should be")
    listener = MetricsListener(spark, "name", "c", str(tmp_path / "taken" / "metrics"))
    listener._rows = [a_row(0, 1)]
    listener.flush()
    assert listener._rows
    with pytest.raises(Exception):  # noqa: B017  whatever the file system says
        listener.flush(last=True)


def test_incomplete_sweep_is_an_error(spark, small, tmp_path):
    base = job.JobParams(
        input_path="given", output_path=str(tmp_path / "o"), checkpoint_path=str(tmp_path / "c"), trigger="available-now"
    )
    with pytest.raises(RuntimeError, match="fewer than 5 batches"):
        job.sweep(
            spark, base, 5, [("1 hour", "available-now")], readings=lambda: feeds.stream_event_readings(spark, small)
        )


def test_whole_summary_is_printed(spark, capsys):
    print_whole(spark.range(250).withColumnRenamed("id", "row"))
    assert len([line for line in capsys.readouterr().out.splitlines() if line.startswith("|")]) == 251


def test_statistics_hash(spark):
    metrics = spark.createDataFrame([a_row(b, 5) for b in range(9)], METRICS_TABLE)
    parsed = stats.with_config_seconds(metrics.withColumn("config", F.lit("file|window=5 seconds|trigger=2 seconds")))
    for frame in (stats.drop_warmup(parsed), stats.steady_state_summary(metrics)):
        assert "SortAggregate" not in frame._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["batch_id"] for r in stats.drop_warmup(parsed).collect()) == list(range(1, 9))


def test_warmup_breaks_ties_by_time_then_row(spark):
    rows = [(None, "2024-01-01 00:00:01"), (2, None), (2, "2024-01-01 00:00:03"), (2, "2024-01-01 00:00:02"), (3, None)]
    frame = spark.createDataFrame([(5, 2, *r) for r in rows], "window_seconds int, trigger_seconds int, batch_id int, timestamp string")
    got = {(r["batch_id"], r["timestamp"]) for r in stats.drop_warmup(frame).collect()}
    assert got == set(rows) - {(2, "2024-01-01 00:00:02")}


def test_warmup_takes_one_exchange_and_odd_numbers_come_last(spark):
    rows = [(1e300, "2024-01-01 00:00:00"), (float("nan"), "2024-01-01 00:00:00"), (5.0, "2024-01-01 00:00:09"), (-3.0, None)]
    frame = spark.createDataFrame([(5, 2, *r) for r in rows], "window_seconds int, trigger_seconds int, batch_id double, timestamp string")
    assert sorted(str(r["batch_id"]) for r in stats.drop_warmup(frame).collect()) == ["1e+300", "5.0", "nan"]
    order = frame.groupBy("window_seconds").agg(F.min_by("batch_id", stats._batch_order()))
    plan = order._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "SortAggregate" not in plan


# --- update log -------------------------------------------------------------------


def write_batch(spark, path, batch, rows):
    spark.createDataFrame(rows, "k string, a int, b int").write.parquet(f"{path}/batch={batch}")


def test_updates_compact(spark, tmp_path):
    path = str(tmp_path / "log")
    write_batch(spark, path, 0, [("x", 1, 1), ("y", 1, 1)])
    write_batch(spark, path, 1, [("x", 2, None)])
    state = [("x", 2, None), ("y", 1, 1)]
    frame = sinks.read_updates(spark, path, ["k"])
    assert "SortAggregate" not in frame._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, frame.collect())) == state
    for _ in range(2):
        sinks.compact_updates(spark, path, ["k"])
        assert sorted(map(tuple, sinks.read_updates(spark, path, ["k"]).collect())) == state
    assert not list((tmp_path / "log").glob("batch=*"))
    write_batch(spark, path, 2, [("y", 3, 3), ("z", 0, 0)])
    sinks.compact_updates(spark, path, ["k"])
    assert sorted(map(tuple, sinks.read_updates(spark, path, ["k"]).collect())) == [("x", 2, None), ("y", 3, 3), ("z", 0, 0)]
    assert [p.name for p in (tmp_path / "log-snapshots").iterdir()] == ["upto=2"]


def test_new_checkpoint_needs_new_log(spark, small, tmp_path):
    (tmp_path / "log" / "batch=0").mkdir(parents=True)
    stream = feeds.stream_event_readings(spark, small)
    with pytest.raises(ValueError, match="another checkpoint"):
        sinks.update_log_sink(stream, str(tmp_path / "log"), str(tmp_path / "new"), "available-now")


# --- regions as columns -----------------------------------------------------------


def test_regions_that_cannot_be_columns(spark):
    rows = [("2024-01-01", r, 1.0) for r in ("la", "LA", "a`b", "window_start")]
    frame = spark.createDataFrame(rows, "window_start string, region string, avg_speed double")
    with pytest.raises(ValueError, match="mean_by_region"):
        trends.pivot_by_region(frame, "avg_speed")
    with pytest.raises(ValueError, match="mean_by_region"):
        trends.pivot_by_region(frame.where("region = 'window_start'"), "avg_speed")
    assert trends.mean_by_region(frame, "avg_speed").count() == 4
    quoted = trends.pivot_by_region(frame.where("region = 'a`b'"), "avg_speed")
    assert quoted.columns == ["window_start", "a`b"]
    assert trends.regions_by_metric(frame, ["avg_speed"])["avg_speed"] == sorted(["la", "LA", "a`b", "window_start"])


# --- intermediate tables and commands -----------------------------------------------


def test_intermediate_tables_go(spark, tmp_path):
    clean(spark)
    folder = Path(shared_folder(spark).removeprefix("file://")) / "roadpulse"
    before = {p.name for p in folder.glob("*")}
    materialise(spark.range(3), "gone").count()
    spark.range(1).write.parquet(fresh_path(spark, "kept"))
    assert len({p.name for p in folder.glob("*")} - before) == 2
    (tmp_path / "a.csv").write_text("Timestamp,Station\n2024-01-01,S1\n")
    main(["chunks", str(tmp_path / "a.csv"), str(tmp_path / "chunks")])
    assert {p.name for p in folder.glob("*")} == before


def test_chunks_in_input_order(spark, tmp_path):
    for name, values in (("b", [1, 9]), ("a", [7, 3, 5])):
        (tmp_path / f"{name}.csv").write_text("n,m\n" + "".join(f"{v},x\n" for v in values))
    got = chunks.assign_chunks(sources.read_named_csv(spark, str(tmp_path)), size=2).collect()
    assert [int(r["n"]) for r in sorted(got, key=lambda r: r["row_position"])] == [7, 3, 5, 1, 9]
    assert sorted(r["chunk_id"] for r in got) == [1, 1, 2, 2, 3]


def test_system_report_of_other_layouts(spark, tmp_path):
    (tmp_path / "m.csv").write_text("batch_id,rows,batch_duration,processed_rps\n0,5,100,50\n1,6,200,30\n")
    tables = system_tables(spark, str(tmp_path / "m.csv"))
    assert "steady_state_summary" not in tables
    assert tables["scaling_curve"].count() == 2
    (tmp_path / "early.csv").write_text("2024-01-01 00:00:00,0,5\n2024-01-01 00:00:09,1,6\n")
    main(["system", str(tmp_path / "early.csv"), "--layout", "early", "--output", str(tmp_path / "out")])
    assert spark.read.parquet(str(tmp_path / "out" / "batch_rows")).count() == 2


def test_ragged_lines_are_counted(spark, tmp_path, capsys):
    whole = ",".join(["11/06/2006 00:00:00"] + ["1"] * 11)
    (tmp_path / "day.txt").write_text(f"{whole}\n\n{whole},1\n{whole},1,2,3,4,5\n11/06/2006 00:00:00,1\n")
    main(["convert", str(tmp_path / "day.txt"), "--output", str(tmp_path / "out")])
    assert "2 lines fill no whole number of lanes" in capsys.readouterr().out


def test_parameters_from_a_file(tmp_path):
    config = tmp_path / "job.json"
    config.write_text(json.dumps({"input_path": "i", "output_path": "o", "checkpoint_path": "c", "window": "1 hour"}))
    options = vars(parse(["stream", "--config", str(config), "--window", "5 seconds"]))
    options.pop("command")
    params = job_params(options)
    assert (params.input_path, params.window, params.trigger) == ("i", "5 seconds", "20 seconds")


def test_publish_options(spark, monkeypatch):
    """Up to the writer: no broker or connector is part of the tests."""
    seen = {}

    class Writer:
        def format(self, name):
            seen["format"] = name
            return self

        def option(self, key, value):
            seen[key] = value
            return self

        def save(self):
            seen["saved"] = True

    class Encoded:
        write = Writer()

    monkeypatch.setattr(kafka, "encode_payload", lambda records: Encoded())
    kafka.publish(spark.range(1), "host:1", "topic")
    assert seen == {"format": "kafka", "kafka.bootstrap.servers": "host:1", "topic": "topic", "saved": True}
