"""File sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from roadpulse.storage import delete, exists, list_names, rename


def write_csv(
    rows: DataFrame, path: str, mode: str = "errorifexists", max_rows_per_file: int | None = None
) -> None:
    """CSV with a header line per part; cells keep their blanks.

    ``max_rows_per_file`` cuts parts into files of at most that many rows, for
    when chunks need not be exact: it costs no shuffle.
    """
    writer = (
        rows.write.mode(mode)
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )
    if max_rows_per_file:
        writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    writer.csv(path)


def write_metrics(rows: DataFrame, path: str) -> None:
    """Batch metrics as CSV, one folder per query and batch; writing one again replaces it."""
    (
        rows.withColumn("batch", F.col("batch_id"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .partitionBy("query_id", "batch")
        .csv(path)
    )


# Number of the folder that holds folded batches; no batch has it.
_FOLDED = -1


def _query_folders(spark: SparkSession, path: str) -> list[str]:
    names = list_names(spark, path) if exists(spark, path) else []
    return [f"{path.rstrip('/')}/{name}" for name in names if name.startswith("query_id=")]


def has_folded_metrics(spark: SparkSession, path: str) -> bool:
    return any(exists(spark, f"{folder}/batch={_FOLDED}") for folder in _query_folders(spark, path))


def compact_metrics(spark: SparkSession, path: str) -> None:
    """Fold the folders of the batches so far into one folder per query, for fast reading.

    Run it while the job does not write metrics. The new rows are complete beside the folder
    before they take the place of the old, and a batch's own folder goes last, so a fold that
    is cut short at any point loses no row, and the next one finishes it.
    """
    for folder in _query_folders(spark, path):
        folded, staged = f"{folder}/batch={_FOLDED}", f"{folder}/_folding"
        if exists(spark, f"{staged}/_SUCCESS") and not exists(spark, folded):
            rename(spark, staged, folded)
        own = [n for n in list_names(spark, folder) if n.startswith("batch=") and n != f"batch={_FOLDED}"]
        if not own:
            continue
        logs = [
            spark.read.schema(spark.read.option("header", True).csv(f"{folder}/{names[0]}").schema)
            .option("header", True)
            .option("enforceSchema", False)
            .csv([f"{folder}/{name}" for name in names])
            .withColumn("batch", F.lit(rank))
            for rank, names in ((1, own), (0, [f"batch={_FOLDED}"] if exists(spark, folded) else []))
            if names
        ]
        rows = logs[0] if len(logs) == 1 else logs[0].unionByName(logs[1], allowMissingColumns=True)
        kept = latest_updates(rows, ["batch_id"])
        ordered = kept.select([name for name in rows.columns if name != "batch"]).coalesce(1)
        write_csv(ordered, staged, mode="overwrite")
        delete(spark, folded)
        rename(spark, staged, folded)
        for name in own:
            delete(spark, f"{folder}/{name}")


def default_csv_path(source_path: str, suffix: str = "") -> str:
    """Beside the source, its name without extension plus ``suffix``."""
    folder, slash, name = source_path.rstrip("/").rpartition("/")
    stem = name.rsplit(".", 1)[0] if "." in name[1:] else name
    return f"{folder}{slash}{stem}{suffix}.csv"


def with_trigger(writer: DataStreamWriter, trigger: str) -> DataStreamWriter:
    """``trigger`` is an interval, or ``available-now`` to drain and stop."""
    if trigger == "available-now":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def parquet_sink(
    stream: DataFrame, path: str, checkpoint: str, trigger: str, name: str | None = None
) -> DataStreamWriter:
    """Append a stream to a Parquet folder exactly once."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return with_trigger(writer.queryName(name) if name else writer, trigger)


def update_log_sink(
    stream: DataFrame, path: str, checkpoint: str, trigger: str, name: str | None = None
) -> DataStreamWriter:
    """Log the rows each batch changed, for results in update mode.

    A batch overwrites its own folder only, so running it again after a failure
    changes nothing. ``read_updates`` reads the current state. A new checkpoint would
    count batches from 0 again and mix with what is there, so it needs a new path.
    """
    spark = stream.sparkSession
    if exists(spark, path) and not exists(spark, f"{checkpoint}/offsets"):
        raise ValueError(f"{path} holds the updates of another checkpoint")

    def write_batch(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    writer = (
        stream.writeStream.outputMode("update")
        .foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
    )
    return with_trigger(writer.queryName(name) if name else writer, trigger)


def latest_updates(log: DataFrame, keys: list[str]) -> DataFrame:
    """The last logged row of every key; hashed and combined on the map side.

    A batch logs a key once, so all values come from the same row.
    """
    values = [name for name in log.columns if name not in (*keys, "batch")]
    return log.groupBy(*keys).agg(*[F.max_by(name, "batch").alias(name) for name in values])


def _snapshots(path: str) -> str:
    return f"{path.rstrip('/')}-snapshots"


def _newest_snapshot(spark: SparkSession, path: str) -> int | None:
    """The last batch a complete snapshot has folded in."""
    if not exists(spark, _snapshots(path)):
        return None
    folders = [name for name in list_names(spark, _snapshots(path)) if name.startswith("upto=")]
    done = [f for f in folders if exists(spark, f"{_snapshots(path)}/{f}/_SUCCESS")]
    return max((int(f.removeprefix("upto=")) for f in done), default=None)


def _log_with_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest snapshot and the batches after it, as one log."""
    upto = _newest_snapshot(spark, path)
    names = list_names(spark, path)
    later = [n for n in names if n.startswith("batch=") and int(n.removeprefix("batch=")) > (-1 if upto is None else upto)]
    parts = [spark.read.option("basePath", path).parquet(*[f"{path}/{n}" for n in later])] if later else []
    if upto is not None:
        parts.append(spark.read.parquet(f"{_snapshots(path)}/upto={upto}"))
    first, *others = parts
    return first.unionByName(others[0]) if others else first


def read_updates(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The current state of an update log."""
    return latest_updates(_log_with_snapshot(spark, path), keys)


def compact_updates(spark: SparkSession, path: str, keys: list[str]) -> None:
    """Fold the batches so far into a snapshot, so that reading the state does not cost all history.

    Run it while no batch is written. The old batches are deleted only once the new
    snapshot is complete; if that is cut short, reading is as before.
    """
    names = [n for n in list_names(spark, path) if n.startswith("batch=")]
    before = _newest_snapshot(spark, path)
    if not names:
        return
    upto = max(int(n.removeprefix("batch=")) for n in names)
    if before is None or upto > before:
        state = latest_updates(_log_with_snapshot(spark, path), keys).withColumn("batch", F.lit(upto))
        state.write.mode("overwrite").parquet(f"{_snapshots(path)}/upto={upto}")
    for name in names:
        delete(spark, f"{path}/{name}")
    if before is not None and before < upto:
        delete(spark, f"{_snapshots(path)}/upto={before}")
