"""Parameters of a streaming job."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields

SOURCES = ("file", "kafka")
SINKS = ("parquet", "updates")


@dataclass(frozen=True)
class JobParams:
    """Everything a streaming job needs to know.

    ``sink`` is ``"parquet"`` for closed windows, each once, or ``"updates"`` for
    a log of every change. ``trigger`` is an interval or ``"available-now"``.
    ``console`` also prints what a batch writes, from the same query. ``count_readings``
    adds the number of readings to each window.
    """

    output_path: str
    checkpoint_path: str
    source: str = "file"
    input_path: str | None = None
    kafka_servers: str = "localhost:9092"
    kafka_topic: str = "traffic-data"
    metrics_path: str | None = None
    window: str = "5 seconds"
    watermark: str = "20 seconds"
    trigger: str = "20 seconds"
    output_mode: str = "append"
    sink: str = "parquet"
    max_files_per_trigger: int | None = None
    max_bytes_per_trigger: int | None = None
    clean_source: str = "off"
    archive_path: str | None = None
    max_offsets_per_trigger: int | None = None
    min_partitions: int | None = None
    output_files: int | None = None
    drop_malformed: bool = False
    console: bool = False
    count_readings: bool = False

    def __post_init__(self) -> None:
        if self.source not in SOURCES:
            raise ValueError(f"source must be one of {SOURCES}, not {self.source!r}")
        if self.sink not in SINKS:
            raise ValueError(f"sink must be one of {SINKS}, not {self.sink!r}")
        if self.source == "file" and not self.input_path:
            raise ValueError("a file source needs input_path")
        if self.max_files_per_trigger and self.max_bytes_per_trigger:
            raise ValueError("limit a trigger by files or by bytes, not by both")
        needed = "append" if self.sink == "parquet" else "update"
        if self.output_mode != needed:
            raise ValueError(f"the {self.sink} sink needs output_mode {needed!r}")

    @property
    def event_time(self) -> str:
        return "ingest" if self.source == "kafka" else "payload"

    @classmethod
    def from_mapping(cls, values: Mapping[str, object]) -> JobParams:
        """Build from a plain mapping; unknown names are an error."""
        known = {field.name for field in fields(cls)}
        unknown = sorted(set(values) - known)
        if unknown:
            raise ValueError(f"unknown parameters: {', '.join(unknown)}")
        return cls(**values)
