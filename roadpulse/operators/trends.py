"""Questions asked of the window aggregates.

The aggregates are meant to be a written table, such as the streaming job's
output: pivots and rolling means read them more than once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: Spark's own limit on pivot columns (spark.sql.pivotMaxValues).
MAX_REGIONS = 10_000


def sorted_aggregates(aggregates: DataFrame) -> DataFrame:
    """Order by region, then time; records without a region come last."""
    return aggregates.orderBy(F.col("region").asc_nulls_last(), "window_start")


def regions_with(aggregates: DataFrame, metric: str, limit: int = MAX_REGIONS) -> list[str]:
    """Regions that have a value of ``metric``; each becomes a column of a pivot.

    More than ``limit`` of them is an error, as it is for Spark's own pivot.
    """
    rows = (
        aggregates.where(F.col("region").isNotNull() & F.col(metric).isNotNull())
        .select("region")
        .distinct()
        .limit(limit + 1)
        .collect()
    )
    if len(rows) > limit:
        raise ValueError(f"more than {limit} regions cannot become columns")
    return sorted(row["region"] for row in rows)


def regions_by_metric(aggregates: DataFrame, metrics: Sequence[str], limit: int = MAX_REGIONS) -> dict[str, list[str]]:
    """``regions_with`` for several metrics in one pass."""
    has = [F.max(F.col(m).isNotNull()).alias(m) for m in metrics]
    rows = aggregates.where(F.col("region").isNotNull()).groupBy("region").agg(*has).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} regions cannot become columns")
    return {m: sorted(row["region"] for row in rows if row[m]) for m in metrics}


def mean_by_region(aggregates: DataFrame, metric: str) -> DataFrame:
    """``window_start, region, mean`` of ``metric``: the pivot's cells as rows, for any number of regions."""
    known = aggregates.where(F.col("region").isNotNull() & F.col(metric).isNotNull())
    return known.groupBy("window_start", "region").agg(F.avg(metric).alias("mean"))


def pivot_by_region(
    aggregates: DataFrame, metric: str, regions: Sequence[str] | None = None
) -> DataFrame:
    """One row per window, one column per region, holding the mean of ``metric``.

    Values that are missing produce neither a row nor a column. Regions whose names
    Spark cannot tell apart as columns, or that are named as the window column is,
    are an error; ``mean_by_region`` has no such limits.
    """
    if regions is None:
        regions = regions_with(aggregates, metric)
    taken: dict[str, str] = {"window_start": "window_start"}
    for region in regions:
        other = taken.setdefault(region.lower(), region)
        if other != region or region == "window_start":
            raise ValueError(f"{region!r} and {other!r} cannot both be columns; use mean_by_region")
    known = aggregates.where(F.col("region").isNotNull() & F.col(metric).isNotNull())
    return known.groupBy("window_start").pivot("region", list(regions)).agg(F.avg(metric))


def rolling_mean(
    aggregates: DataFrame, measures: Mapping[str, str], rows: int = 3, slot: str = "day"
) -> DataFrame:
    """Add, per region in time order, the mean over the current and earlier rows.

    ``measures`` maps each new column to its source column. Missing values are
    skipped; where all ``rows`` values are missing, or the region is, the mean
    is NULL.

    A region's history is not sorted in one task. It is cut into calendar slots,
    and each slot is handed the last ``rows - 1`` rows before it, which is all
    its first frames need. Slots hold at most one row per window, so their size
    is bounded by slot length over window width.
    """
    if rows < 1:
        raise ValueError("rows must be at least 1")
    sources = sorted(set(measures.values()))
    # The measures break ties between rows of one window, alike in both orders.
    upwards = [F.col("window_start").asc(), *[F.col(name).asc() for name in sources]]
    downwards = [F.col("window_start").desc(), *[F.col(name).desc() for name in sources]]

    slotted = aggregates.withColumn("_slot", F.date_trunc(slot, "window_start")).withColumn(
        "_carried", F.lit(False)
    )
    if rows > 1:
        newest_first = Window.partitionBy("region", "_slot").orderBy(*downwards)
        tails = (
            slotted.select("region", "window_start", *sources, "_slot")
            .withColumn("_age", F.row_number().over(newest_first))
            .where(F.col("_age") < rows)
        )
        # At most rows - 1 tail rows per region and slot are left. The slots of
        # a row's next neighbours are the slots whose frames reach back to it.
        in_time = Window.partitionBy("region").orderBy(*upwards)
        reaching = F.array_distinct(
            F.array(*[F.lead("_slot", step).over(in_time) for step in range(1, rows)])
        )
        carried = (
            tails.withColumn("_reaching", reaching)
            .withColumn("_reaching", F.explode("_reaching"))
            .where(F.col("_reaching") != F.col("_slot"))
            .select(
                "region",
                "window_start",
                *sources,
                F.col("_reaching").alias("_slot"),
                F.lit(True).alias("_carried"),
            )
        )
        slotted = slotted.unionByName(carried, allowMissingColumns=True)

    frame = Window.partitionBy("region", "_slot").orderBy(*upwards).rowsBetween(1 - rows, 0)
    means = {
        name: F.when(F.col("region").isNotNull(), F.avg(source).over(frame))
        for name, source in measures.items()
    }
    return slotted.withColumns(means).where(~F.col("_carried")).drop("_slot", "_carried")


def rolling_measures(aggregates: DataFrame) -> DataFrame:
    """Rolling speed and congestion over three windows."""
    return rolling_mean(
        aggregates, {"avg_speed_roll": "avg_speed", "congestion_roll": "congestion_index"}
    )


def peak_congestion(aggregates: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` most congested windows; ties go by region, then time."""
    return (
        aggregates.orderBy(
            F.col("congestion_index").desc_nulls_last(),
            F.col("region").asc_nulls_last(),
            "window_start",
        )
        .select("window_start", "region", "congestion_index")
        .limit(k)
    )


def congestion_against_speed(aggregates: DataFrame) -> DataFrame:
    """Speed and congestion pairs of every window with a region."""
    return aggregates.where(F.col("region").isNotNull()).select(
        "region", "avg_speed", "congestion_index"
    )
