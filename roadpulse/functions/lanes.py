"""Column names of a raw station line of a given width."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadpulse.schemas import BASE_COLUMNS, LANE_FIELDS


def lane_count(width: Column) -> Column:
    spare = width - len(BASE_COLUMNS)
    return F.greatest(F.floor(spare / len(LANE_FIELDS)).cast("int"), F.lit(0))


def layout_names(width: Column) -> Column:
    """Names for ``width`` cells: base, then lanes, then numbered surplus cells.

    A line shorter than the base columns gets the first ``width`` names.
    """
    lanes = lane_count(width)
    named = len(BASE_COLUMNS) + lanes * len(LANE_FIELDS)
    lane_names = F.flatten(
        F.transform(
            _numbers(F.lit(1), lanes),
            lambda lane: F.array(
                *[F.format_string(f"Lane %d {field}", lane) for field in LANE_FIELDS]
            ),
        )
    )
    surplus = F.transform(_numbers(named, width - 1), lambda at: F.format_string("Extra_%d", at))
    base = F.array(*[F.lit(name) for name in BASE_COLUMNS])
    return F.slice(F.concat(base, lane_names, surplus), F.lit(1), width)


def _numbers(first: Column, last: Column) -> Column:
    # sequence() counts downwards when last < first; such a range is empty here.
    return F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
