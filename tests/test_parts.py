"""Folding the Parquet output of a stream."""

from __future__ import annotations

import shutil
from pathlib import Path

import pytest

from roadpulse.sinks.files import parquet_sink
from roadpulse.sinks.parts import compact_parts, read_parts


class Feed:
    """A stream of numbers into a Parquet folder, one batch and some files a call."""

    def __init__(self, spark, folder: Path):
        self.spark, self.inbox = spark, str(folder / "in")
        self.output, self.checkpoint = str(folder / "out"), str(folder / "checkpoint")
        self.sent = 0

    def batch(self, rows: int = 8) -> None:
        self.spark.range(self.sent, self.sent + rows, 1, 4).write.mode("append").parquet(self.inbox)
        self.sent += rows
        stream = self.spark.readStream.schema("id bigint").parquet(self.inbox).repartition(4)
        query = parquet_sink(stream, self.output, self.checkpoint, "available-now").start()
        query.awaitTermination()

    def read(self) -> list[int]:
        return sorted(row["id"] for row in read_parts(self.spark, self.output).collect())

    def parts(self) -> list[str]:
        return [p.name for p in Path(self.output).glob("part-*")]


def test_fold_resume_fold(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    for _ in range(12):  # beyond the commit log's own compaction
        feed.batch()
    before = feed.parts()
    assert len(before) >= 12
    assert compact_parts(spark, feed.output) == len(before)
    assert not feed.parts()
    assert len(list((tmp_path / "out-rolls").glob("roll=*/rows/part-*"))) == 1
    assert feed.read() == list(range(feed.sent))
    assert compact_parts(spark, feed.output) == 0
    for _ in range(9):  # the log is compacted again, with folded files in it
        feed.batch()
    assert feed.read() == list(range(feed.sent))
    assert compact_parts(spark, feed.output) > 0
    feed.batch()
    assert feed.read() == list(range(feed.sent))


def test_a_fold_cut_short_loses_and_doubles_nothing(spark, tmp_path, monkeypatch):
    feed = Feed(spark, tmp_path)
    feed.batch()
    feed.batch()
    shutil.copytree(feed.output, tmp_path / "copy")
    compact_parts(spark, feed.output)
    # Cut short before the list of files was whole: the rows written are not a roll yet.
    (tmp_path / "out-rolls" / "roll=000000" / "files" / "_SUCCESS").unlink()
    shutil.copytree(tmp_path / "copy", feed.output, dirs_exist_ok=True)
    assert feed.read() == list(range(feed.sent))
    assert compact_parts(spark, feed.output) > 0
    # Cut short while the folded files were deleted.
    shutil.copytree(tmp_path / "copy", feed.output, dirs_exist_ok=True)
    feed.batch()
    assert feed.read() == list(range(feed.sent))
    compact_parts(spark, feed.output)
    assert not feed.parts()
    assert feed.read() == list(range(feed.sent))


def test_a_batch_not_committed_is_not_folded(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.batch()
    shutil.copy(next(Path(feed.output).glob("part-*")), Path(feed.output) / "part-99999-stray.parquet")
    compact_parts(spark, feed.output)
    assert feed.read() == list(range(feed.sent))


def test_a_folder_without_a_log_is_refused(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "plain"))
    with pytest.raises(ValueError, match="commit log"):
        compact_parts(spark, str(tmp_path / "plain"))
    assert read_parts(spark, str(tmp_path / "plain")).count() == 3
