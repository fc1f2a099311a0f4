"""File sources: station files, window aggregates, batch metrics."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.functions.cells import ISO_TIME, to_number
from roadpulse.schemas import BASE_COLUMNS, EARLY_METRICS, LANE_FIELDS, STATION_LINE, STATION_TEXT, STATION_TYPED
from roadpulse.sinks.files import has_folded_metrics, latest_updates
from roadpulse.sinks.parts import read_parts
from roadpulse.storage import first_line


def stream_station_files(
    spark: SparkSession,
    path: str,
    typed: bool = False,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
    clean_source: str = "off",
    archive_path: str | None = None,
) -> DataFrame:
    """New CSV files with a header line, bound to the fixed schema by position.

    ``typed`` reads numbers as numbers, a cell that is none becoming NULL.
    A limit of files or of bytes paces a replay; ``clean_source``
    (``archive`` or ``delete``) keeps the folder from growing.
    """
    reader = (
        spark.readStream.format("csv")
        .option("header", True)
        .option("cleanSource", clean_source)
        .schema(STATION_TYPED if typed else STATION_TEXT)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    if archive_path:
        reader = reader.option("sourceArchiveDir", archive_path)
    return reader.load(path)


# Files whose first lines are read at once.
_OPEN_FILES = 16


def literal_paths(encoded: list[str]) -> list[str]:
    """Paths as Spark reports them, for use as paths to read: without URL codes, without patterns."""
    return [re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(path)) for path in encoded]


def files_by_first_line(spark: SparkSession, path: str) -> dict[str | None, list[str]]:
    """The files of a folder by their first line that is not blank; ``None`` for files without one.

    Opens each file once, on the driver, which lists the files anyway; of the files only
    their first lines are read.
    """
    files = spark.read.text(path).inputFiles()
    with ThreadPoolExecutor(_OPEN_FILES) as pool:
        lines = list(pool.map(lambda file: first_line(spark, unquote(file)), files))
    grouped: dict[str | None, list[str]] = {}
    for line, file in sorted(zip(lines, files), key=lambda pair: pair[1]):
        grouped.setdefault(line, []).append(file)
    return grouped


def _reader_of(spark: SparkSession, path: str, files: list[str]):
    """A reader of some files of ``path`` and what to load; folders named ``key=value`` stay columns."""
    reader = spark.read
    if not re.search(r"[\\{}\[\]*?]", path) and [unquote(f).rpartition("/")[2] for f in files] != [path.rpartition("/")[2]]:
        reader = reader.option("basePath", path)
    return reader, literal_paths(files)


def _read_layout(spark: SparkSession, path: str, files: list[str] | None = None) -> DataFrame:
    """Files with one header, all text; another header, as of a file that changed meanwhile, is an error."""
    reader, paths = _reader_of(spark, path, files) if files else (spark.read, path)
    schema = reader.option("header", True).csv(paths[0] if files else path).schema
    return reader.schema(schema).option("header", True).option("enforceSchema", False).csv(paths)


def csv_layouts(spark: SparkSession, path: str) -> list[DataFrame]:
    """CSV files with a header, one table per distinct header, all text.

    A layout is one scan, so columns and filters are pushed down as for a folder of one
    layout, whose plan is the plain scan of the folder. Files without a line have no layout.
    """
    grouped = files_by_first_line(spark, path)
    grouped.pop(None, None)
    if len(grouped) <= 1:
        return [_read_layout(spark, path)]
    return [_read_layout(spark, path, files) for files in grouped.values()]


def _together(tables: list[DataFrame]) -> DataFrame:
    return reduce(lambda some, more: some.unionByName(more, allowMissingColumns=True), tables)


def read_named_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV files with a header each, all text, columns by name.

    Each file is read by its own header: columns may stand in another order, and a
    column that a file does not have is NULL in its rows.
    """
    return _together(csv_layouts(spark, path))


def read_station_csv(spark: SparkSession, path: str) -> DataFrame:
    """Batch CSV with a header: columns by their own names, all text."""
    return read_named_csv(spark, path)


def read_station_text(spark: SparkSession, path: str, files: list[str] | None = None) -> DataFrame:
    """Headerless station lines of any width as the twelve base columns.

    Surplus cells are cut off by the CSV reader, missing ones become NULL. A line of
    names among them is an error, as its file has a header. ``files`` are some of those in ``path``.
    """
    reader, paths = _reader_of(spark, path, files) if files else (spark.read, path)
    lines = reader.schema(STATION_LINE).csv(paths)
    first = lines.columns[0]
    named = F.lower(F.trim(first)) == first.lower()
    checked = F.when(named, F.raise_error(F.lit("a station file has a header, others have none")).cast("string"))
    return lines.withColumn(first, checked.otherwise(F.col(first)))


def _is_header(line: str) -> bool:
    """A first cell with ``/`` or ``-`` is a date, another one a name."""
    cell = line.split(",", 1)[0]
    return "/" not in cell and "-" not in cell


def has_header(spark: SparkSession, path: str) -> bool:
    """Whether all files that have a line start with names."""
    firsts = [line for line in files_by_first_line(spark, path) if line is not None]
    return bool(firsts) and all(map(_is_header, firsts))


def read_station_files(spark: SparkSession, path: str) -> DataFrame:
    """Station files, each by its own first line: all named columns, or base columns if unnamed.

    The first line that is not blank tells which. Columns that a file does not have are NULL
    in its rows.
    """
    grouped = files_by_first_line(spark, path)
    grouped.pop(None, None)
    named = {line: files for line, files in grouped.items() if _is_header(line)}
    unnamed = [file for line, files in grouped.items() if line not in named for file in files]
    if not named:
        return read_station_text(spark, path)
    if not unnamed:
        return _together(
            [_read_layout(spark, path)]
            if len(named) == 1
            else [_read_layout(spark, path, files) for files in named.values()]
        )
    tables = [_read_layout(spark, path, files) for files in named.values()]
    return _together([*tables, read_station_text(spark, path, unnamed)])


def count_ragged_lines(spark: SparkSession, path: str) -> int:
    """Lines of headerless files whose cells fill neither the base columns nor whole lanes."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    surplus = F.size(F.split("value", ",", -1)) - len(BASE_COLUMNS)
    return lines.where((surplus < 0) | (surplus % len(LANE_FIELDS) != 0)).count()


def read_aggregates(spark: SparkSession, *paths: str) -> DataFrame:
    """All Parquet parts of one or several aggregate folders as one table.

    A folder written by a stream is read through its commit log, so parts of an
    unfinished batch are left out; what ``compact_parts`` folded is read in its place. Folders
    per batch, as jobs with several outputs write them, are one table.
    """
    first, *others = [read_parts(spark, path).drop("batch") for path in paths]
    for other in others:
        first = first.unionByName(other)
    return first


def _current_names(rows: DataFrame) -> DataFrame:
    """A layout of batch metrics under the current names, so that it can stand beside others."""
    names = {}
    if "duration_sec" not in rows.columns and "batch_duration" in rows.columns:
        names["duration_sec"] = (to_number(F.col("batch_duration")) / 1000).cast("string")
    if "throughput_rows_per_sec" not in rows.columns and "processed_rps" in rows.columns:
        names["throughput_rows_per_sec"] = F.col("processed_rps")
    if "config" not in rows.columns:
        names["config"] = F.lit("default")
    return rows.withColumns(names).drop("batch_duration", "processed_rps")


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Batch metrics CSV with a header, in any accepted layout.

    Columns keep their names; times and numbers are typed, bad cells are NULL. Where files
    of a folder have different layouts, those of older ones get the current names. Of a row
    that is in a folder of its own and in one that ``compact_metrics`` wrote, the own one counts.
    """
    layouts = csv_layouts(spark, path)
    text = _together([_current_names(rows) for rows in layouts] if len(layouts) > 1 else layouts)
    if {"query_id", "batch"} <= set(text.columns) and has_folded_metrics(spark, path):
        log = text.withColumn("batch", F.col("batch").cast("bigint"))
        text = latest_updates(log, ["query_id", "batch_id"]).withColumn("batch", F.col("batch_id"))
    numbers = [
        "duration_sec",
        "throughput_rows_per_sec",
        "batch_duration",
        "processed_rps",
    ]
    counts = ["batch_id", "rows", "has_speed", "has_count", "dropped_late"]
    typed = {name: to_number(F.col(name)) for name in numbers if name in text.columns}
    typed |= {
        name: to_number(F.col(name)).try_cast("bigint") for name in counts if name in text.columns
    }
    if "timestamp" in text.columns:
        typed["timestamp"] = F.try_to_timestamp(F.col("timestamp"), F.lit(ISO_TIME))
    return text.withColumns(typed)


def read_early_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The early headerless layout: time, batch number, row count."""
    text = spark.read.schema(EARLY_METRICS).csv(path)
    return text.select(
        F.try_to_timestamp(F.col("timestamp"), F.lit(ISO_TIME)).alias("timestamp"),
        F.col("batch_id").try_cast("bigint").alias("batch_id"),
        F.col("rows").try_cast("bigint").alias("rows"),
    )
