from __future__ import annotations

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from roadpulse.operators.windows import window_aggregate
from roadpulse.plans.reports import system_tables, traffic_tables, write_tables
from roadpulse.schemas import STATION_TEXT
from roadpulse.sinks.console import console_sink, print_whole
from roadpulse.sinks.fanout import fan_out_sink
from roadpulse.sinks.files import compact_metrics, latest_updates, parquet_sink, update_log_sink, write_metrics
from roadpulse.sources.files import read_aggregates, read_metrics, stream_station_files
from roadpulse.sources.kafka import kafka_options
from roadpulse.streaming import job
from roadpulse.streaming.open_windows import current_windows, readings_ledger
from roadpulse.streaming.params import JobParams
from roadpulse.streaming.progress import METRICS_TABLE, MetricsListener

START = dt.datetime(2024, 1, 1, 8)
HEADER = ",".join(STATION_TEXT.names)


def line(second, district="7", flow="10", speed="40"):
    moment = START + dt.timedelta(seconds=second)
    return f"{moment},S1,{district},5,N,ML,.5,30,100,{flow},.1,{speed},LA"


def drop(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([HEADER, *lines]) + "\n")


def params(tmp_path, **changes):
    values = {
        "input_path": str(tmp_path / "in"),
        "output_path": str(tmp_path / "out"),
        "checkpoint_path": str(tmp_path / "checkpoint"),
        "metrics_path": str(tmp_path / "metrics"),
        "trigger": "available-now",
        "window": "5 seconds",
    }
    return JobParams(**{**values, **changes})


def results(spark, path):
    rows = read_aggregates(spark, str(path)).withColumn(
        "window_start", F.col("window_start").cast("timestamp_ntz")
    )
    return {
        (row["region"], int((row["window_start"] - START).total_seconds())): row["total_vehicles"]
        for row in rows.collect()
    }


def test_late_rows_are_dropped_two_batches_on(spark, tmp_path):
    """The batch right after an advance still counts rows the advance outdates."""
    inbox, given = tmp_path / "in", params(tmp_path)
    dropped = []
    for number, seconds in enumerate([[0, 300], [600], [1], [1200]]):
        drop(inbox, f"{number}.csv", *[line(second) for second in seconds])
        running = job.start(spark, given)
        running.await_end()
        dropped.append(
            sum(op.numRowsDroppedByWatermark for p in running.query.recentProgress for op in p.stateOperators)
        )
    assert dropped == [0, 0, 1, 0]
    reported = read_metrics(spark, given.metrics_path).orderBy("batch_id").collect()
    assert [row["dropped_late"] for row in reported] == dropped
    assert results(spark, given.output_path) == {("LA", 0): 10, ("LA", 300): 10, ("LA", 600): 10}


def test_restart_repeats_nothing(spark, tmp_path):
    inbox, given = tmp_path / "in", params(tmp_path)
    drop(inbox, "a.csv", line(0), line(3), line(60))
    job.run(spark, given)
    job.run(spark, given)
    drop(inbox, "b.csv", line(61), line(200))
    job.run(spark, given)
    rows = read_aggregates(spark, given.output_path)
    assert rows.count() == 2
    assert results(spark, given.output_path) == {("LA", 0): 20, ("LA", 60): 20}


def test_stream_equals_batch_on_closed_windows(spark, tmp_path):
    inbox, given = tmp_path / "in", params(tmp_path)
    lines = [line(n, district=str(n % 9), flow=str(n % 7), speed=str(n % 5)) for n in range(0, 400, 3)]
    drop(inbox, "a.csv", *lines, line(10, flow=" ", speed="NA"), "no time,S1,7,,,,,,,,,,")
    job.run(spark, given)
    from roadpulse.operators.readings import canonical_readings

    batch = canonical_readings(spark.read.schema(STATION_TEXT).option("header", True).csv(str(inbox)))
    last = F.lit(START + dt.timedelta(seconds=399 - 20))
    closed = window_aggregate(batch, "5 seconds").where(F.col("window_end") <= last)
    assert sorted(map(str, read_aggregates(spark, given.output_path).collect())) == sorted(
        map(str, closed.collect())
    )


def test_metrics_rows(spark, tmp_path):
    given = params(tmp_path, max_files_per_trigger=1)
    drop(tmp_path / "in", "a.csv", line(0), line(1, flow="", speed="x"), "no time,S1,7,,,,,,,,,,")
    time.sleep(0.05)
    drop(tmp_path / "in", "b.csv", line(100), line(101), line(102))
    running = job.start(spark, given)
    running.await_end()
    # Metrics come without another scan or another copy of the state.
    last = running.query.lastProgress
    assert (len(last.sources), len(last.stateOperators)) == (1, 1)
    rows = read_metrics(spark, given.metrics_path).orderBy("batch_id").collect()
    assert [(row["batch_id"], row["rows"]) for row in rows] == [(0, 2), (1, 3)]
    assert [(row["has_speed"], row["has_count"]) for row in rows] == [(1, 1), (3, 3)]
    assert {row["config"] for row in rows} == {"file|window=5 seconds|trigger=available-now"}
    for row in rows:
        assert row["duration_sec"] > 0
        assert row["throughput_rows_per_sec"] == pytest.approx(row["rows"] / row["duration_sec"], abs=1e-3)


def test_trigger_limited_by_bytes(spark, tmp_path):
    for name in "abc":
        drop(tmp_path / "in", f"{name}.csv", line(0), line(60))
        time.sleep(0.05)
    job.run(spark, params(tmp_path, max_bytes_per_trigger=1))
    rows = read_metrics(spark, str(tmp_path / "metrics")).collect()
    assert sorted(row["rows"] for row in rows) == [2, 2, 2]


def without_reports(monkeypatch):
    """As if the driver died before it wrote a metrics row."""
    monkeypatch.setattr(MetricsListener, "flush", lambda self, last=False: None)


def facts(spark, path):
    rows = read_metrics(spark, path).orderBy("batch_id").collect()
    return [(row["batch_id"], row["rows"], row["has_speed"], row["has_count"]) for row in rows]


@pytest.mark.parametrize("archived", [False, True])
def test_lost_metrics_are_made_again(spark, tmp_path, monkeypatch, archived):
    inbox = tmp_path / "in box"
    moves = {"clean_source": "archive", "archive_path": str(tmp_path / "old")} if archived else {}
    given = params(tmp_path, input_path=str(inbox), max_files_per_trigger=1, **moves)
    for number, lines in enumerate([[line(0), line(1, speed="x")], ["no time,S1,7,,,,,,,,,,"], [line(100, flow="")]]):
        drop(inbox, f"{number}.csv", *lines)
        time.sleep(0.05)
    with monkeypatch.context() as dead:
        without_reports(dead)
        job.run(spark, given)
    assert not (tmp_path / "metrics").exists()
    drop(inbox, "later.csv", line(200), line(201))
    job.run(spark, given)
    got = facts(spark, given.metrics_path)
    assert got[:2] == [(0, 2, 1, 2), (2, 1, 1, 0)] and [row[1] for row in got[2:]] == [2]
    made, *_ = read_metrics(spark, given.metrics_path).orderBy("batch_id").collect()
    assert made["duration_sec"] > 0 and made["dropped_late"] is None and made["timestamp"].year > 2024
    assert made["throughput_rows_per_sec"] == pytest.approx(2 / made["duration_sec"], abs=1e-3)
    # Once made, a row is not made again.
    job.run(spark, given)
    assert facts(spark, given.metrics_path) == got


def test_lost_batches_whose_files_are_gone_are_named(spark, tmp_path, monkeypatch):
    given = params(tmp_path)
    drop(tmp_path / "in", "a.csv", line(0), line(60))
    with monkeypatch.context() as dead:
        without_reports(dead)
        job.run(spark, given)
    (tmp_path / "in" / "a.csv").unlink()
    job.run(spark, given)
    assert facts(spark, given.metrics_path)[0] == (0, None, None, None)


def test_folded_metrics_read_as_before(spark, tmp_path):
    given, folder = params(tmp_path, max_files_per_trigger=1), tmp_path / "metrics"

    def table():
        return sorted(map(str, read_metrics(spark, str(folder)).select(*METRICS_TABLE.names).collect()))

    for names in ("abc", "d", "e"):
        for name in names:
            drop(tmp_path / "in", f"{name}.csv", line(0), line(60))
            time.sleep(0.05)
        job.run(spark, given)
        before = table()
        compact_metrics(spark, str(folder))
        assert table() == before
        assert [path.name for path in folder.glob("query_id=*/batch=*")] == ["batch=-1"]
    (query,) = [path.name.removeprefix("query_id=") for path in folder.iterdir() if path.is_dir()]
    read = {row[0]: row[1] for row in facts(spark, str(folder))}
    assert list(read.values()) == [2] * 5
    # A batch that runs again replaces its row although it has been folded.
    again = max(read)
    row = ("2024-01-01 00:00:00", again, 7, 0.5, 14.0, "c", "run", 7, 7, 0, query)
    write_metrics(spark.createDataFrame([row], METRICS_TABLE), str(folder))
    assert {r[0]: r[1] for r in facts(spark, str(folder))} == {**read, again: 7}
    compact_metrics(spark, str(folder))
    assert {r[0]: r[1] for r in facts(spark, str(folder))} == {**read, again: 7}


def test_a_fold_cut_short_is_finished(spark, tmp_path):
    folder = tmp_path / "metrics"
    rows = [("2024-01-01 00:00:00", n, n + 1, 0.5, 2.0, "c", "run", 1, 1, 0, "q") for n in range(3)]
    write_metrics(spark.createDataFrame(rows, METRICS_TABLE), str(folder))
    compact_metrics(spark, str(folder))
    # Its rows stood ready beside the folder, and the folder was gone.
    (folder / "query_id=q" / "batch=-1").rename(folder / "query_id=q" / "_folding")
    write_metrics(spark.createDataFrame([(*rows[0][:1], 3, *rows[0][2:])], METRICS_TABLE), str(folder))
    compact_metrics(spark, str(folder))
    assert [row[:2] for row in facts(spark, str(folder))] == [(0, 1), (1, 2), (2, 3), (3, 1)]


def test_unwritable_metrics_are_reported_when_the_job_is_done(spark, tmp_path):
    (tmp_path / "metrics").write_text("a file, not a folder")
    given = params(tmp_path, metrics_path=str(tmp_path / "metrics" / "x"))
    drop(tmp_path / "in", "a.csv", line(0), line(60))
    with pytest.raises(Exception):  # noqa: B017  whatever the file system says
        job.run(spark, given)
    assert results(spark, given.output_path) == {("LA", 0): 10}


def test_update_log_holds_open_windows(spark, tmp_path):
    given = params(tmp_path, sink="updates", output_mode="update", output_files=2)
    drop(tmp_path / "in", "a.csv", line(0), line(60))
    job.run(spark, given)
    drop(tmp_path / "in", "b.csv", line(61, flow="5"))
    job.run(spark, given)
    log = spark.read.parquet(given.output_path)
    state = latest_updates(log, ["region", "window_start", "window_end"])
    got = sorted(row["total_vehicles"] for row in state.collect())
    assert got == [10, 15]


def test_update_batch_can_run_twice(spark, tmp_path):
    inbox = tmp_path / "in"
    drop(inbox, "a.csv", line(0), line(1))
    path = str(tmp_path / "log")
    for _ in range(2):
        stream = job.windowed_stream(job.stream_readings(spark, params(tmp_path)), "5 seconds", "20 seconds")
        update_log_sink(stream, path, str(tmp_path / "c"), "available-now").start().awaitTermination()
        # As if the driver had died before it noted the batch as done.
        for commit in (tmp_path / "c" / "commits").glob("*"):
            commit.unlink()
    assert [row["total_vehicles"] for row in spark.read.parquet(path).collect()] == [20]


def test_typed_source_and_early_job(spark, tmp_path):
    drop(tmp_path / "in", "a.csv", line(0, flow="1.5"), line(1, flow="bad", speed="50"))
    stream = stream_station_files(spark, str(tmp_path / "in"), typed=True)
    assert dict(stream.dtypes)["Total Flow"] == "double"
    parquet_sink(stream, str(tmp_path / "o"), str(tmp_path / "c"), "available-now").start().awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "o")).orderBy("Timestamp").collect()
    assert [(row["Total Flow"], row["Avg Speed"]) for row in rows] == [(1.5, 40.0), (None, 50.0)]


def printed_rows(query):
    return sum(progress.sink.numOutputRows for progress in query.recentProgress)


def test_console(spark, tmp_path, capfd):
    """Files and console come from one query, with one scan and one copy of the state."""
    drop(tmp_path / "in", "a.csv", line(0), line(60))
    given = params(tmp_path, console=True)
    running = job.start(spark, given)
    running.await_end()
    assert [len(p.sources) for p in running.query.recentProgress if p.numInputRows] == [1]
    assert len(running.query.lastProgress.stateOperators) == 1
    assert capfd.readouterr().out.count("|LA ") == 1
    assert results(spark, given.output_path) == {("LA", 0): 10}
    assert [row["rows"] for row in read_metrics(spark, given.metrics_path).collect()] == [2]
    with pytest.raises(ValueError, match="was started with a console"):
        job.start(spark, params(tmp_path))
    stream = job.windowed_stream(job.stream_readings(spark, params(tmp_path)), "5 seconds", "20 seconds")
    query = console_sink(stream, "available-now", mode="update", rows=20).start()
    query.awaitTermination()
    assert printed_rows(query) == 2


def test_repeated_batch_goes_once_to_each_output(spark, tmp_path):
    """The second output fails after the first has its batch; then the driver forgets that all is done."""
    inbox, checkpoint, seen = tmp_path / "in", str(tmp_path / "c"), {"first": [], "second": []}
    drop(inbox, "a.csv", line(0), line(1), line(60))
    failing = [True]

    def first(rows, batch):
        seen["first"] += [(batch, row["total_vehicles"]) for row in rows.collect()]

    def second(rows, batch):
        got = [(batch, row["total_vehicles"]) for row in rows.collect()]
        if got and failing.pop(0):
            raise RuntimeError("second output is away")
        seen["second"] += got

    def run():
        stream = job.windowed_stream(job.stream_readings(spark, params(tmp_path)), "5 seconds", "20 seconds")
        query = fan_out_sink(stream, {"first": first, "second": second}, checkpoint, "available-now").start()
        query.awaitTermination()
        return query

    with pytest.raises(Exception, match="second output is away"):
        run()
    failing[:] = [False] * 9
    run()
    assert [n for _, n in seen["first"]] == [20] and seen["second"] == seen["first"]
    last = max(int(f.name) for f in (tmp_path / "c" / "commits").glob("[0-9]*"))
    for name in (f"{last}", f".{last}.crc"):
        (tmp_path / "c" / "commits" / name).unlink()
    run()
    # The state survived the repeated batch: the next window is whole.
    drop(inbox, "b.csv", line(61), line(200))
    run()
    assert [n for _, n in seen["first"]] == [20, 20] and seen["second"] == seen["first"]
    assert list((tmp_path / "c" / "staged").glob("batch=*")) == []


def test_open_windows_and_ledger(spark, tmp_path):
    """A window without speeds, one without a region, late readings that combine to one row, unread times."""
    inbox, given = tmp_path / "in", params(tmp_path, count_readings=True)
    drop(inbox, "a.csv", line(0), line(1), line(300, speed="x"), line(301, district="", flow=""))
    job.run(spark, given)
    before = {(r["region"], r["is_open"]): r for r in current_windows(spark, given.output_path, given.checkpoint_path, True).collect()}
    assert before["LA", False]["readings"] == 2 and before["LA", True]["avg_speed"] is None
    assert before["LA", True]["total_vehicles"] == 10 and before[None, True]["total_vehicles"] is None
    drop(inbox, "b.csv", line(600), "no time,S1,7,,,,,,,,,,")
    job.run(spark, given)
    drop(inbox, "c.csv", line(0), line(1), line(2), line(601))
    job.run(spark, given)
    (row,) = readings_ledger(spark, given.output_path, given.checkpoint_path, given.metrics_path).collect()
    assert row.asDict() == {"arrived": 9, "emitted": 4, "open_now": 2, "late": 3}
    dropped = read_metrics(spark, given.metrics_path).agg(F.sum("dropped_late")).first()[0]
    assert dropped < 3  # Spark's own number is of combined rows


def test_kafka_job_uses_broker_time(spark, tmp_path, monkeypatch):
    """The Kafka source itself is replaced; decoding and event time are not."""
    inbox = str(tmp_path / "messages")
    messages = [
        ('{"Station": "1", "District": "7.0", "Total Flow": "5.9", "Avg Speed": "10"}', START),
        ('{"Station": "1", "District": "7", "Total Flow": "4", "Timestamp": "bad"}', START),
        ("not json", START),
        (None, START),
        ('{"District": "8", "Total Flow": "", "Avg Speed": "2"}', START + dt.timedelta(minutes=5)),
        ("{}", START + dt.timedelta(hours=1)),
    ]
    frame = spark.createDataFrame(messages, "value string, timestamp timestamp_ntz")
    frame = frame.select(F.col("value").cast("binary"), F.col("timestamp").cast("timestamp"))
    frame.write.parquet(inbox)

    def stream_messages(session, options):
        assert options["subscribe"] == "readings"
        return session.readStream.schema(frame.schema).parquet(inbox)

    monkeypatch.setattr(job, "stream_messages", stream_messages)
    given = params(tmp_path, source="kafka", kafka_topic="readings", input_path=None)
    job.run(spark, given)
    assert results(spark, given.output_path) == {("LA", 0): 9, (None, 0): None, ("8", 300): None}
    labels = {row["config"] for row in read_metrics(spark, given.metrics_path).collect()}
    assert labels == {"kafka|window=5 seconds|trigger=available-now"}


def test_kafka_options():
    options = kafka_options("a:1,b:2", "readings", max_offsets_per_trigger=1000, min_partitions=64)
    group = options.pop("groupIdPrefix")
    assert group != kafka_options("a:1", "readings")["groupIdPrefix"]
    assert options == {
        "kafka.bootstrap.servers": "a:1,b:2",
        "subscribe": "readings",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "1000",
        "minPartitions": "64",
    }


@pytest.mark.parametrize(
    ("changes", "message"),
    [
        ({"output_mode": "update"}, "needs output_mode 'append'"),
        ({"output_mode": "complete"}, "needs output_mode 'append'"),
        ({"sink": "updates"}, "needs output_mode 'update'"),
        ({"sink": "csv"}, "sink must be"),
        ({"source": "socket"}, "source must be"),
        ({"input_path": None}, "needs input_path"),
        ({"max_files_per_trigger": 1, "max_bytes_per_trigger": 1}, "not by both"),
    ],
)
def test_bad_params(tmp_path, changes, message):
    with pytest.raises(ValueError, match=message):
        params(tmp_path, **changes)


def test_params_from_mapping():
    given = JobParams.from_mapping({"output_path": "o", "checkpoint_path": "c", "source": "kafka"})
    assert (given.event_time, given.window, given.watermark) == ("ingest", "5 seconds", "20 seconds")
    with pytest.raises(ValueError, match="unknown parameters: mode"):
        JobParams.from_mapping({"output_path": "o", "checkpoint_path": "c", "mode": "append"})


def test_sweep_ends_without_input(spark, tmp_path):
    (tmp_path / "in").mkdir()
    began = time.monotonic()
    with pytest.raises(RuntimeError, match="fewer than 1 batches"):
        job.sweep(spark, params(tmp_path), 1, [("5 seconds", "1 second")], limit_seconds=1)
    assert time.monotonic() - began < 40


def test_reports(spark, tmp_path, capfd):
    given = params(tmp_path, max_files_per_trigger=1)
    for number in range(3):
        drop(tmp_path / "in", f"{number}.csv", line(number * 60), line(number * 60 + 30, district="8"))
        time.sleep(0.05)
    configurations = [("5 seconds", "1 second")]
    job.sweep(spark, given, batches=3, configurations=configurations)
    system = system_tables(spark, given.metrics_path)
    summary = system["steady_state_summary"].collect()
    assert [(row["short_label"], row["batches"]) for row in summary] == [("W5–T1", 2)]
    print_whole(system["steady_state_summary"])
    assert "W5–T1" in capfd.readouterr().out
    traffic = traffic_tables(spark, f"{given.output_path}/w5seconds-t1second", top=2)
    write_tables({**system, **traffic}, str(tmp_path / "report"))
    pivot = spark.read.parquet(str(tmp_path / "report" / "avg_speed"))
    assert set(pivot.columns) <= {"window_start", "LA", "8"} and pivot.count() > 0
    assert spark.read.parquet(str(tmp_path / "report" / "peak_congestion")).count() == 2
