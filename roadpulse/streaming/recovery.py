"""Metrics rows of batches that were committed, but whose report died with the driver.

Spark reports a batch once. Its checkpoint still names the batches that are done, when each
began, and the files each has read, so a row can be made again.
"""

from __future__ import annotations

import json
from functools import reduce
from urllib.parse import unquote, urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.operators.readings import canonical_readings, completeness
from roadpulse.schemas import STATION_TEXT
from roadpulse.sources.files import literal_paths, read_metrics
from roadpulse.storage import exists, list_names
from roadpulse.streaming.params import JobParams


def _line(number: int) -> Column:
    return F.get(F.split("value", "\n"), F.lit(number))


def query_id(spark: SparkSession, checkpoint: str) -> str | None:
    """The id a query keeps over restarts, or nothing if it has not started."""
    if not exists(spark, f"{checkpoint}/metadata"):
        return None
    text = spark.read.text(f"{checkpoint}/metadata", wholetext=True).first()
    return json.loads(text["value"])["id"]


def _log(spark: SparkSession, folder: str) -> DataFrame:
    """One row per entry of a checkpoint's log: ``batch_id``, ``value``, ``written``."""
    entries = spark.read.text(folder, wholetext=True)
    name = F.col("_metadata.file_name")
    return entries.where(name.rlike("^[0-9]+$")).select(
        name.cast("bigint").alias("batch_id"), "value", F.col("_metadata.file_modification_time").alias("written")
    )


def committed_batches(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Batches the checkpoint still knows as done: ``batch_id, started, seconds, before, upto``.

    A batch lasts from the start of its trigger to its commit. It has read what came after entry
    ``before`` of the source's log, up to entry ``upto``; ``before`` is NULL where the
    batch ahead is no longer known, both are NULL for a source without such a log. One row
    per batch that Spark keeps (``spark.sql.streaming.minBatchesToRetain``).
    """
    source = _line(2)
    offsets = _log(spark, f"{checkpoint}/offsets").select(
        "batch_id",
        F.get_json_object(_line(1), "$.batchTimestampMs").cast("bigint").alias("started_ms"),
        F.get_json_object(F.when(source.startswith("{"), source), "$.logOffset").cast("bigint").alias("upto"),
    )
    ahead = offsets.select((F.col("batch_id") + 1).alias("batch_id"), F.col("upto").alias("before"))
    done = _log(spark, f"{checkpoint}/commits").select("batch_id", "written")
    began = F.to_utc_timestamp(F.timestamp_millis("started_ms"), F.current_timezone())
    return (
        done.join(offsets, "batch_id")
        .join(ahead, "batch_id", "left")
        .select(
            "batch_id",
            F.date_format(began, "yyyy-MM-dd HH:mm:ss").alias("started"),
            ((F.unix_millis("written") - F.col("started_ms")) / 1000).alias("seconds"),
            F.when(F.col("batch_id") == 0, -1).otherwise(F.col("before")).alias("before"),
            "upto",
        )
    )


def _files_read(spark: SparkSession, checkpoint: str, batches: DataFrame) -> dict[int, list[str]]:
    """The files that each of some batches has read, as the source's log names them."""
    log = spark.read.text(f"{checkpoint}/sources/0").where(F.col("value").startswith("{"))
    entries = log.select(
        F.get_json_object("value", "$.path").alias("path"),
        F.get_json_object("value", "$.batchId").cast("bigint").alias("entry"),
    ).distinct()
    # At most the batches Spark keeps on the broadcast side.
    read = entries.join(
        F.broadcast(batches), (F.col("entry") > F.col("before")) & (F.col("entry") <= F.col("upto"))
    )
    files: dict[int, list[str]] = {}
    for row in read.select("batch_id", "path").orderBy("batch_id", "path").toLocalIterator():
        files.setdefault(row["batch_id"], []).append(row["path"])
    return files


def _kept(spark: SparkSession, path: str, archive: str | None) -> str | None:
    """Where a file is now: in its place, in the archive, or gone."""
    places = [path, *([f"{archive.rstrip('/')}{urlsplit(path).path}"] if archive else [])]
    return next((place for place in places if exists(spark, unquote(place))), None)


def recovered_metrics(
    spark: SparkSession, params: JobParams, config: str, recount: bool = True
) -> DataFrame | None:
    """Rows for the batches that are committed and not among the metrics, or nothing if none lack.

    Readings are counted again from the files a batch has read. Where these are gone, the
    source has no files, or ``recount`` is off as its readings are not station files, the batch is named with its time and duration and NULL counts.
    A batch without readings has no row, as ever. ``run_id`` and ``dropped_late`` are not
    known afterwards and NULL; the label is that of the job as it is started now.
    """
    checkpoint = params.checkpoint_path
    ident = query_id(spark, checkpoint)
    if ident is None or not exists(spark, f"{checkpoint}/commits") or not list_names(spark, f"{checkpoint}/commits"):
        return None
    lacking = committed_batches(spark, checkpoint)
    if exists(spark, params.metrics_path) and list_names(spark, params.metrics_path):
        known = read_metrics(spark, params.metrics_path)
        if "query_id" in known.columns:
            lacking = lacking.join(known.where(F.col("query_id") == ident), "batch_id", "left_anti")
    rows = lacking.collect()
    if not rows:
        return None
    lost = spark.createDataFrame(rows, lacking.schema)
    from_files = recount and params.source == "file" and exists(spark, f"{checkpoint}/sources/0")
    files = _files_read(spark, checkpoint, lost) if from_files else {}
    counts = [lost.select("batch_id", *[F.lit(None).cast("bigint").alias(n) for n in ("rows", "has_speed", "has_count")]).limit(0)]
    empty = [row["batch_id"] for row in rows if row["upto"] is not None and row["before"] == row["upto"]]
    for batch, paths in files.items():
        places = [_kept(spark, path, params.archive_path) for path in paths]
        if None in places:
            continue
        records = spark.read.schema(STATION_TEXT).option("header", True).csv(literal_paths(places))
        counted = canonical_readings(records, params.event_time).agg(*completeness())
        counts.append(
            counted.select(F.lit(batch).cast("bigint").alias("batch_id"), F.col("total").alias("rows"), "has_speed", "has_count")
        )
    found = lost.join(reduce(DataFrame.unionByName, counts), "batch_id", "left")
    rate = F.when(F.col("seconds") > 0, F.round(F.col("rows") / F.col("seconds"), 3)).otherwise(0.0)
    return found.where(~F.col("batch_id").isin(empty) & (F.col("rows").isNull() | (F.col("rows") > 0))).select(
        F.col("started").alias("timestamp"),
        "batch_id",
        "rows",
        F.col("seconds").alias("duration_sec"),
        F.when(F.col("rows").isNotNull(), rate).alias("throughput_rows_per_sec"),
        F.lit(config).alias("config"),
        F.lit(None).cast("string").alias("run_id"),
        "has_speed",
        "has_count",
        F.lit(None).cast("bigint").alias("dropped_late"),
        F.lit(ident).alias("query_id"),
    )
