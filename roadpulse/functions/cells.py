"""Text cells to usable values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.schemas import HOME_DISTRICT, HOME_REGION

# Text patterns of event times. The station files allow one-digit
# months, days and hours; the cleaned files do not.
ISO_TIME = "yyyy-MM-dd HH:mm:ss"
_ISO_SHAPE = r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d\z"
STATION_TIME = "M/d/yyyy H:m:s"


def blank_to_null(text: Column) -> Column:
    """NULL for text of blanks only; any other text is returned untrimmed."""
    return F.when(F.length(F.trim(text)) > 0, text)


def first_filled(rows: DataFrame, names: Sequence[str]) -> Column:
    """First non-blank value, as text, among the named columns that ``rows`` has."""
    known = set(rows.columns)
    filled = [blank_to_null(F.col(name).cast("string")) for name in names if name in known]
    return F.coalesce(*filled, F.lit(None).cast("string"))


def to_number(text: Column) -> Column:
    """Text to double; unreadable text and NaN become NULL.

    NaN is mapped to NULL because a single NaN would turn the average of its
    whole window into NaN.
    """
    return F.nanvl(text.try_cast("double"), F.lit(None).cast("double"))


def to_whole(text: Column) -> Column:
    """Text to int, cutting decimals; ``12.7`` gives 12, out of range NULL."""
    return to_number(text).try_cast("int")


def region_of(district: Column) -> Column:
    """The home district's region name, or the district's own text."""
    return F.when(to_whole(district) == HOME_DISTRICT, HOME_REGION).otherwise(district)


def read_time(text: Column) -> Column:
    """Text in exactly the ISO pattern to a time, anything else to NULL.

    Casting text of a checked shape gives what the pattern would, at about half
    the cost of Spark's general pattern parser.
    """
    return F.when(text.rlike(_ISO_SHAPE), text.try_cast("timestamp"))


def station_time_to_iso(text: Column) -> Column:
    """Rewrite a station-file time in ISO order; unreadable times become NULL."""
    return F.date_format(F.try_to_timestamp(text, F.lit(STATION_TIME)), ISO_TIME)
