"""One query, several outputs: one scan and one copy of the state for all of them."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from roadpulse.sinks.files import with_trigger, write_csv
from roadpulse.storage import delete, exists, touch

# Writes the rows of a batch, given its number.
Output = Callable[[DataFrame, int], None]

# Batches whose marks are kept; only the newest can run again.
_KEPT_MARKS = 100


def ledger_path(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}/outputs"


def parquet_output(path: str) -> Output:
    """A folder per batch; a batch that runs again replaces its own."""

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    return write


def csv_output(path: str) -> Output:
    """As ``parquet_output``, as CSV with a header."""

    def write(rows: DataFrame, batch: int) -> None:
        write_csv(rows, f"{path}/batch={batch}", mode="overwrite")

    return write


def console_output(rows_shown: int = 200) -> Output:
    """Print up to ``rows_shown`` rows of a batch."""

    def show(rows: DataFrame, batch: int) -> None:
        print(f"Batch: {batch}")
        rows.show(rows_shown, truncate=False)

    return show


def fan_out_sink(
    stream: DataFrame,
    outputs: Mapping[str, Output],
    checkpoint: str,
    trigger: str,
    name: str | None = None,
    mode: str = "append",
) -> DataStreamWriter:
    """Hand the rows of each batch to all ``outputs``, in their order.

    A batch is computed once, into a folder beside the checkpoint, and the outputs read
    that. A mark per output and batch is set when the output is done, so a batch that
    runs again after a failure goes only to the outputs that do not have it. An output
    that dies half-way sees its batch again and must replace what it wrote, as those
    to folders do; the console may print a batch twice.

    A batch that runs again is computed even if all outputs have it: that brings the
    window state to the version the next batch starts from.
    """
    ledger, staging = ledger_path(checkpoint), f"{checkpoint.rstrip('/')}/staged"

    def write_batch(computed: DataFrame, batch: int) -> None:
        spark = computed.sparkSession
        staged = f"{staging}/batch={batch}"
        computed.write.mode("overwrite").parquet(staged)
        rows = spark.read.schema(computed.schema).parquet(staged)
        for output, write in outputs.items():
            mark = f"{ledger}/{output}/{batch}"
            if not exists(spark, mark):
                write(rows, batch)
                touch(spark, mark)
                delete(spark, f"{ledger}/{output}/{batch - _KEPT_MARKS}")
        delete(spark, staged)

    writer = stream.writeStream.outputMode(mode).foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return with_trigger(writer.queryName(name) if name else writer, trigger)
