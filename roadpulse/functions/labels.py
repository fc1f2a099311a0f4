"""Labels that name a streaming configuration."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def config_label(source: Column, window: Column, trigger: Column) -> Column:
    return F.concat_ws("|", source, F.concat(F.lit("window="), window), F.concat(F.lit("trigger="), trigger))


def config_text(source: str, window: str, trigger: str) -> str:
    """The same label for a job that is about to start."""
    return f"{source}|window={window}|trigger={trigger}"


def seconds_of(label: Column, part: str) -> Column:
    """The leading whole number of one part of a label, whatever its unit.

    NULL if the part is missing or does not start with a whole number.
    """
    pattern = rf"(?:^|\|)\s*{part}=\s*([+-]?\d+)(?:\s|\||$)"
    return F.regexp_extract(label, pattern, 1).try_cast("int")


def short_label(window_seconds: Column, trigger_seconds: Column) -> Column:
    return F.format_string("W%d–T%d", window_seconds, trigger_seconds)
