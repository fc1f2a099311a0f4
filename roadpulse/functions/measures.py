"""Traffic measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def congestion(vehicles: Column, speed: Column) -> Column:
    """Vehicles per unit of speed to two digits, NULL where nothing moves."""
    return F.when(speed > 0, F.round(vehicles / speed, 2))
