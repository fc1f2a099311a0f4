"""Small helpers the operators share: isolated input columns, order, Arrow batches."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Sequence
from pathlib import Path

import roadpulse
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.storage import materialise

# A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
# Rows an Arrow batch may hold. Texts may be very long, so a batch of the default
# 10,000 rows could outgrow a Python worker.
BATCH_ROWS = 128
# Short rows that are worth a partition, and a file, of their own.
PARTITION_ROWS = 1 << 17
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def for_python(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Make ready for plans with Python in their tasks.

    Bounds the Arrow batches of the plans run next (a smaller bound set by the
    caller stays), and hands this package to the executors, once per session.
    """
    context = spark.sparkContext
    now = int(spark.conf.get(_BATCH_SETTING))
    if now <= 0 or now > rows or now == getattr(context, "_roadpulse_batch", None):
        spark.conf.set(_BATCH_SETTING, str(rows))
        context._roadpulse_batch = rows
    if getattr(context, "_roadpulse_shipped", False):
        return
    folder = Path(roadpulse.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="roadpulse-")) / "roadpulse.zip"
    with zipfile.ZipFile(archive, "w") as file:
        for source in sorted(folder.rglob("*.py")):
            file.write(source, source.relative_to(folder.parent))
    context.addPyFile(str(archive))
    context._roadpulse_shipped = True


def only(table: DataFrame, **columns: str | Column) -> DataFrame:
    """The named columns alone, so that other columns of the table cannot clash."""
    return table.select(*[(table[c] if isinstance(c, str) else c).alias(name) for name, c in columns.items()])


def width(spark: SparkSession) -> int:
    """Partitions of a range partitioning, which Spark needs as a number here."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def folded(rows: DataFrame, most: int) -> DataFrame:
    """``rows``, of which there are ``most`` at most, in no more partitions than they need.

    A partition then has at least ``PARTITION_ROWS`` rows, or there is one for each core. For
    rows just dealt by an aggregate's key, which are as many in each partition.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.coalesce(max(cores, -(-most // PARTITION_ROWS)))


def ranked(rows: DataFrame, order: Sequence[Column], label: str) -> DataFrame:
    """``rows``, written once, with ``at``: their place from 0 in ``order``, over all partitions.

    A range partitioning sorts; a row's place is its place within its partition
    plus the sizes of the partitions before. Only these sizes, one number per
    partition, meet in one task. No key is held together, so a hot one is no
    worse than any other. Ties are broken by place in their partition, so
    ``order`` should be unique where places must not change between runs.
    """
    local = F.monotonically_increasing_id()
    sorted_rows = rows.repartitionByRange(width(rows.sparkSession), *order).sortWithinPartitions(*order)
    kept = materialise(sorted_rows.withColumn("_id", local), label)
    kept = kept.withColumn("_part", F.shiftrightunsigned("_id", 33))
    sizes = kept.groupBy("_part").agg(F.count("*").alias("_n"))
    starts = sizes.select(
        "_part",
        F.expr("sum(_n) over (order by _part rows between unbounded preceding and current row) - _n").alias("_start"),
    )
    place = F.col("_start") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return kept.join(F.broadcast(starts), "_part").withColumn("at", place).drop("_id", "_part", "_start")
