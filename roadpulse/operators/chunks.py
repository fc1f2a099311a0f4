"""Consecutive chunks of equal row count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.storage import materialise

# Fixed value: monotonically_increasing_id() keeps the partition number above,
# and the row's place in its partition in, the lower 33 bits (Spark API docs).
_PLACE_BITS = 33
# A row group is read by one task, however files are split; ranges are far smaller than this.
_ONE_ROW_GROUP = {"parquet.block.size": str(2**31 - 1)}


def assign_chunks(
    records: DataFrame,
    order: Sequence[str] | None = None,
    size: int = 5000,
    from_scan: bool = False,
    borders: bool = False,
) -> DataFrame:
    """Add ``row_position`` (from 1, in ``order``) and ``chunk_id`` (from 1).

    Without ``order`` rows stay as they are in the files that ``records`` are a scan
    of: by file path, then place in the file.

    The rows are range partitioned by ``order`` with a tie breaker, so equal
    keys may spread over tasks, and numbered inside their partition. The ranged
    rows are written once, which freezes those numbers; the count of rows before
    each partition then turns them into global positions. No task sees more than
    its range, and the broadcast side has one row per partition.

    The tie breaker is a row's place in its input partition, which must be the
    same when a lost task runs again. That holds for a scan of files, which
    ``from_scan`` asserts; other input is written first.

    ``borders`` adds ``crosses_border``: whether the row's chunk lies in more than one of
    the ranges that were written. Each range is then one row group, which one task reads whole
    and in order, so all rows of a chunk that crosses no border are in one task.
    """
    if size < 1:
        raise ValueError("size must be at least 1")
    if not order:
        return _in_input_order(records, size, borders)
    stable = records if from_scan else materialise(records, "unchunked")
    ranged = (
        stable.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(*order, "_tie")
        .sortWithinPartitions(*order, "_tie")
        .drop("_tie")
        .withColumn("_place", F.monotonically_increasing_id())
    )
    numbered = materialise(ranged, "chunks", **(_ONE_ROW_GROUP if borders else {})).withColumn(
        "_part", F.shiftright("_place", _PLACE_BITS)
    )
    counts = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_part")) - F.col("_rows")
    total = F.sum("_rows").over(Window.partitionBy())
    offsets = counts.select("_part", before.alias("_before"), "_rows", total.alias("_total"))

    place = F.col("_place").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    placed = numbered.join(F.broadcast(offsets), "_part").withColumn(
        "row_position", F.col("_before") + place + 1
    )
    assigned = placed.withColumn("chunk_id", F.expr(f"(row_position - 1) div {int(size)} + 1"))
    if borders:
        starts_before = (F.col("chunk_id") - 1) * size < F.col("_before")
        end = F.col("_before") + F.col("_rows")
        ends_after = (F.col("chunk_id") * size > end) & (end < F.col("_total"))
        assigned = assigned.withColumn("crosses_border", starts_before | ends_after)
    return assigned.drop("_part", "_place", "_before", "_rows", "_total")


def _in_input_order(records: DataFrame, size: int, borders: bool) -> DataFrame:
    """A split of a file is read in order, and ids rise within it."""
    names = ["_file", "_block", "_line"]
    placed = records.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    )
    return assign_chunks(placed, names, size, from_scan=True, borders=borders).drop(*names)


def placed_chunks(assigned: DataFrame) -> DataFrame:
    """``assigned``, with a ``chunk`` label, each chunk in one task and in order.

    With ``crosses_border`` (see ``assign_chunks``) rows stay in the task that reads them,
    but for the chunks cut by the end of a task's range: at most two a task, and only
    these are shuffled. Without it all rows are.
    """
    labelled = assigned.withColumn("chunk", F.format_string("%04d", "chunk_id"))
    if "crosses_border" in assigned.columns:
        crosses = F.col("crosses_border")
        labelled = labelled.where(~crosses).union(labelled.where(crosses).repartition("chunk")).drop("crosses_border")
    else:
        labelled = labelled.repartition("chunk")
    return labelled.sortWithinPartitions("chunk", "row_position")


def write_chunks(assigned: DataFrame, path: str) -> None:
    """One CSV file with header per chunk, its rows in order; none exceeds the chunk size."""
    (
        placed_chunks(assigned)
        .drop("chunk_id", "row_position")
        .write.partitionBy("chunk")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
