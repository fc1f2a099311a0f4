"""Tables written half-way through a job, on storage every executor can reach."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

FOLDER_SETTING = "spark.checkpoint.dir"


@cache
def _single_machine_folder() -> str:
    return tempfile.mkdtemp(prefix="roadpulse-")


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for intermediate tables and checkpoints.

    Only a single-machine session without the setting gets a local folder; on a
    cluster a local folder would be lost with its machine.
    """
    folder = spark.conf.get(FOLDER_SETTING, None)
    if not folder:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError(f"set {FOLDER_SETTING} to a folder all executors share")
        folder = _single_machine_folder()
    return folder.rstrip("/")


def _file_system(spark: SparkSession, path: str):
    """The Hadoop path and the file system it is in, whatever the store."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, files = _file_system(spark, path)
    return files.exists(where)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder."""
    where, files = _file_system(spark, path)
    return sorted(status.getPath().getName() for status in files.listStatus(where))


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a text file that is not blank, compressed files included; reads no further."""
    where, files = _file_system(spark, path)
    codecs = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(
        spark.sparkContext._jsc.hadoopConfiguration()
    )
    codec, stream = codecs.getCodec(where), files.open(where)
    try:
        content = codec.createInputStream(stream) if codec else stream
        reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(content, "UTF-8"))
        while (line := reader.readLine()) is not None:
            if line.strip():
                return line
        return None
    finally:
        stream.close()


def touch(spark: SparkSession, path: str) -> None:
    """Make an empty file, with its folders."""
    where, files = _file_system(spark, path)
    files.create(where, True).close()


def delete(spark: SparkSession, path: str) -> None:
    where, files = _file_system(spark, path)
    files.delete(where, True)


def rename(spark: SparkSession, path: str, target: str) -> None:
    where, files = _file_system(spark, path)
    if not files.rename(where, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"could not rename {path} to {target}")


# Paths handed out, by application, until they are cleaned.
_handed_out: dict[str, list[str]] = {}


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; ``clean``, or the end of the session, deletes what is there."""
    path = f"{shared_folder(spark)}/roadpulse/{label}-{uuid.uuid4().hex}"
    where, files = _file_system(spark, path)
    files.deleteOnExit(where)
    _handed_out.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clean(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application; nothing may read them any more."""
    for path in _handed_out.pop(spark.sparkContext.applicationId, []):
        delete(spark, path)


def materialise(rows: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``rows`` once and read them back.

    Used where a plan reads the same rows more than once, or where row ids must
    not change between two reads. The written files survive lost executors and
    are read back with column pruning.
    """
    path = fresh_path(rows.sparkSession, label)
    rows.write.options(**options).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
