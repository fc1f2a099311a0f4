"""Command line: ``spark-submit`` or ``python -m roadpulse <command> ...``."""

from __future__ import annotations

import argparse
import json
import typing
from dataclasses import fields

from pyspark.sql import SparkSession

from roadpulse.operators.chunks import assign_chunks, write_chunks
from roadpulse.operators.cleaning import cleaning_audit, prepare
from roadpulse.operators.payloads import payload_key_profile, payload_samples
from roadpulse.plans.reports import system_tables, traffic_tables, write_tables
from roadpulse.session import build_session
from roadpulse.sinks.console import print_whole
from roadpulse.sinks.files import default_csv_path, write_csv
from roadpulse.sinks.kafka import publish
from roadpulse.sources.files import count_ragged_lines, has_header, read_station_csv, read_station_files
from roadpulse.sources.kafka import KAFKA_PACKAGE, kafka_options
from roadpulse.storage import clean
from roadpulse.streaming import job
from roadpulse.streaming.params import JobParams


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="roadpulse", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    stream = commands.add_parser(
        "stream",
        help="run the streaming job",
        epilog="Without --max-files-per-trigger or --max-bytes-per-trigger the first trigger takes all"
        " files there are, and without --output-files a trigger writes a file per shuffle partition.",
    )
    swept = commands.add_parser("sweep", help="run the job once per window and trigger")
    swept.add_argument("--batches", type=int, default=10)
    swept.add_argument("--limit-seconds", type=float, default=3600)
    types = typing.get_type_hints(JobParams)
    for command in (stream, swept):
        command.add_argument("--config", help="a JSON file of parameters; flags go before it")
        for field in fields(JobParams):
            flag = "--" + field.name.replace("_", "-")
            if types[field.name] is bool:
                command.add_argument(flag, action="store_true", default=argparse.SUPPRESS)
            else:
                number = int in typing.get_args(types[field.name])
                command.add_argument(flag, type=int if number else str, default=argparse.SUPPRESS)

    watched = commands.add_parser("watch", help="print changing aggregates of typed CSV files")
    watched.add_argument("input")
    watched.add_argument("--trigger", default="20 seconds")

    converted = commands.add_parser("convert", help="name the columns of raw station files")
    converted.add_argument("input")
    converted.add_argument("--output")

    prepared = commands.add_parser("prepare", help="clean station files into CSV")
    prepared.add_argument("input")
    prepared.add_argument("--output")
    prepared.add_argument("--region-mode", default="constant", choices=["constant", "district"])

    chunks = commands.add_parser("chunks", help="split CSV into chunks of equal row count")
    chunks.add_argument("input")
    chunks.add_argument("output")
    chunks.add_argument("--chunk-size", type=int, default=5000)
    chunks.add_argument("--order", nargs="+", help="columns to sort by; the order of the input if not given")

    published = commands.add_parser("publish", help="send station files as JSON messages")
    published.add_argument("input")
    profiled = commands.add_parser("profile", help="print the keys and some values of JSON messages")
    for command in (published, profiled):
        command.add_argument("--kafka-servers", default="localhost:9092")
        command.add_argument("--kafka-topic", default="traffic-data")

    traffic = commands.add_parser("traffic", help="write the traffic report tables")
    traffic.add_argument("aggregates", nargs="+")
    traffic.add_argument("--output", required=True)
    traffic.add_argument("--top", type=int, default=5)

    system = commands.add_parser("system", help="write the batch metrics report tables")
    system.add_argument("metrics")
    system.add_argument("--output", required=True)
    system.add_argument("--layout", default="named", choices=["named", "early"])
    return parser.parse_args(arguments)


def job_params(options: dict) -> JobParams:
    """Parameters from flags and, where these are silent, from the configuration file."""
    config = options.pop("config", None)
    given = {}
    if config:
        with open(config, encoding="utf-8") as file:
            given = json.load(file)
    return JobParams.from_mapping({**given, **options})


def main(arguments: list[str] | None = None) -> None:
    options = vars(parse(arguments))
    command = options.pop("command")
    kafka = command in ("publish", "profile")
    limits = {name: options.pop(name) for name in ("batches", "limit_seconds") if name in options}
    params = job_params(options) if command in ("stream", "sweep") else None
    kafka |= params is not None and params.source == "kafka"
    spark = build_session(**({"spark.jars.packages": KAFKA_PACKAGE} if kafka else {}))
    try:
        if command == "stream":
            job.run(spark, params)
        elif command == "sweep":
            job.sweep(spark, params, limits["batches"], limit_seconds=limits["limit_seconds"])
        elif command == "watch":
            job.watch(spark, options["input"], options["trigger"]).awaitTermination()
        else:
            on_files(spark, command, options)
    finally:
        clean(spark)


def on_files(spark: SparkSession, command: str, options: dict) -> None:
    """The commands that end by themselves."""
    if command == "convert":
        records = read_station_files(spark, options["input"])
        write_csv(records, options["output"] or default_csv_path(options["input"]))
        if not has_header(spark, options["input"]):
            print(f"{count_ragged_lines(spark, options['input'])} lines fill no whole number of lanes")
    elif command == "prepare":
        records = read_station_files(spark, options["input"])
        output = options["output"] or default_csv_path(options["input"], "_final")
        write_csv(prepare(records, options["region_mode"]), output)
        cleaning_audit(records).show(truncate=False)
    elif command == "chunks":
        records = read_station_csv(spark, options["input"])
        assigned = assign_chunks(records, options["order"], options["chunk_size"], from_scan=True, borders=True)
        write_chunks(assigned, options["output"])
    elif command == "publish":
        publish(read_station_files(spark, options["input"]), options["kafka_servers"], options["kafka_topic"])
    elif command == "profile":
        topic = kafka_options(options["kafka_servers"], options["kafka_topic"])
        messages = spark.read.format("kafka").options(**topic).load()
        print_whole(payload_key_profile(messages))
        payload_samples(messages).show(truncate=False)
    elif command == "traffic":
        tables = traffic_tables(spark, *options["aggregates"], top=options["top"])
        write_tables(tables, options["output"])
    else:
        tables = system_tables(spark, options["metrics"], options["layout"])
        write_tables(tables, options["output"])
        if "steady_state_summary" in tables:
            print_whole(tables["steady_state_summary"])


if __name__ == "__main__":
    main()
