"""The Parquet folder a stream appends to, folded from many small files into few."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadpulse.storage import delete, exists, list_names

_LOG = "_spark_metadata"


def _rolls_folder(path: str) -> str:
    return f"{path.rstrip('/')}-rolls"


def _committed(spark: SparkSession, path: str) -> list[str]:
    """Names of the files the stream has committed; no file is opened for it."""
    return [file.rpartition("/")[2] for file in spark.read.schema("unread int").parquet(path).inputFiles()]


def _rolls(spark: SparkSession, path: str) -> list[str]:
    """Complete rolls in order: the list of a roll's files is written after its rows."""
    folder = _rolls_folder(path)
    names = list_names(spark, folder) if exists(spark, folder) else []
    return [f"{folder}/{name}" for name in names if exists(spark, f"{folder}/{name}/files/_SUCCESS")]


def _folded(spark: SparkSession, rolls: list[str]) -> set[str]:
    """Names of the files that are in a roll. As many as the commit log lists, which the driver reads anyway."""
    return {row["value"] for row in spark.read.text([f"{roll}/files" for roll in rolls]).collect()} if rolls else set()


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    """A folder of Parquet parts: what ``compact_parts`` has folded and the files after it, each row once.

    Without a roll this is the plain read of the folder, through its commit log if it has one.
    """
    rolls = _rolls(spark, path)
    if not rolls:
        return spark.read.parquet(path)
    rolled = spark.read.parquet(*[f"{roll}/rows" for roll in rolls])
    later = sorted(set(_committed(spark, path)) - _folded(spark, rolls))
    if not later:
        return rolled
    return rolled.unionByName(spark.read.parquet(*[f"{path}/{name}" for name in later]))


def compact_parts(spark: SparkSession, path: str) -> int:
    """Fold the files a stream has committed since the last time into a roll of few files; their number.

    The commit log is not touched, so the stream may run on or resume: it only adds files,
    and those committed meanwhile are left to the next call. A call reads and writes new files
    only, not earlier rolls; sizes of the files come from the session's advisory partition size.
    The folded files are deleted once the roll is complete. A call that is cut short before
    leaves the folder as it was, one that is cut short after it is made up for by the next.
    From then on the folder is read by ``read_parts``, and no reader may be at work meanwhile.
    """
    if not exists(spark, f"{path}/{_LOG}"):
        raise ValueError(f"{path} has no commit log of a stream")
    rolls = _rolls(spark, path)
    folded, there = _folded(spark, rolls), set(list_names(spark, path))
    for name in folded & there:
        delete(spark, f"{path}/{name}")
    new = sorted(set(_committed(spark, path)) - folded)
    if not new:
        return 0
    roll = f"{_rolls_folder(path)}/roll={len(rolls):06d}"
    rows = spark.read.parquet(*[f"{path}/{name}" for name in new])
    rows.hint("rebalance").write.mode("overwrite").parquet(f"{roll}/rows")
    names = spark.createDataFrame([(name,) for name in new], "value string")
    names.coalesce(1).write.mode("overwrite").text(f"{roll}/files")
    for name in new:
        delete(spark, f"{path}/{name}")
    return len(new)
