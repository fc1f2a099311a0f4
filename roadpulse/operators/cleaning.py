"""Batch preparation of station records.

Every step is a projection or a filter, so the whole preparation is one scan
without a shuffle; only the audit adds a one-row aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.cells import region_of, station_time_to_iso, to_number
from roadpulse.schemas import BASE_COLUMNS, HOME_REGION


def keep_base_columns(records: DataFrame) -> DataFrame:
    return records.select([name for name in BASE_COLUMNS if name in records.columns])


def lane_columns(records: DataFrame) -> list[str]:
    """Columns that ``keep_base_columns`` removes as lane detail or surplus."""
    return [
        name
        for name in records.columns
        if name.startswith(("Lane ", "Extra_")) and name not in BASE_COLUMNS
    ]


def drop_unobserved(records: DataFrame) -> DataFrame:
    """Drop records with nothing observed; an unknown share is kept."""
    share = to_number(F.col("% Observed"))
    return records.withColumn("% Observed", share).where(~_is_zero(F.col("% Observed")))


def drop_missing(records: DataFrame, measure: str) -> DataFrame:
    """Make ``measure`` numeric and drop the records without a value for it."""
    return records.withColumn(measure, to_number(F.col(measure))).where(F.col(measure).isNotNull())


def reformat_times(records: DataFrame) -> DataFrame:
    """Rewrite event times in ISO order; records with unreadable times stay."""
    return records.withColumn("Timestamp", station_time_to_iso(F.col("Timestamp")))


def add_region(records: DataFrame, mode: str = "constant") -> DataFrame:
    """``"constant"`` names every record's region alike, ``"district"`` maps it."""
    if mode == "constant":
        region = F.lit(HOME_REGION)
    elif mode == "district":
        region = region_of(F.col("District"))
    else:
        raise ValueError(f"mode must be 'constant' or 'district', not {mode!r}")
    return records.withColumn("region", region)


def prepare(records: DataFrame, region_mode: str = "constant") -> DataFrame:
    """Base columns, cleaned, with ISO times and a region.

    A step whose column is absent is left out.
    """
    kept = keep_base_columns(records)
    if "% Observed" in kept.columns:
        kept = drop_unobserved(kept)
    for measure in ("Total Flow", "Avg Speed"):
        if measure in kept.columns:
            kept = drop_missing(kept, measure)
    if "Timestamp" in kept.columns:
        kept = reformat_times(kept)
    return add_region(kept, region_mode if "District" in kept.columns else "constant")


def cleaning_audit(records: DataFrame) -> DataFrame:
    """Rows each rule removes, in rule order, from one pass over the records.

    A record counts for the first rule that removes it. Columns: ``step``,
    ``rule``, ``rows_removed``, ``pct_of_input``, ``rows_remaining``.
    """
    checks: list[tuple[str, Column]] = []
    if "% Observed" in records.columns:
        checks.append(("unobserved", _is_zero(to_number(F.col("% Observed")))))
    if "Total Flow" in records.columns:
        checks.append(("no flow", to_number(F.col("Total Flow")).isNull()))
    if "Avg Speed" in records.columns:
        checks.append(("no speed", to_number(F.col("Avg Speed")).isNull()))

    failed = F.lit(0)
    for step, (_, fails) in reversed(list(enumerate(checks, 1))):
        failed = F.when(fails, step).otherwise(failed)
    per_step = [
        F.count_if(F.col("failed") == step).alias(f"removed_{step}")
        for step in range(1, len(checks) + 1)
    ]
    totals = records.select(failed.alias("failed")).agg(F.count(F.lit(1)).alias("total"), *per_step)

    removed_so_far = F.lit(0).cast("bigint")
    lines = []
    for step, (rule, _) in enumerate(checks, 1):
        removed = F.col(f"removed_{step}")
        removed_so_far = removed_so_far + removed
        lines.append(_audit_line(step, rule, removed, F.col("total") - removed_so_far))
    lines.append(_audit_line(len(checks) + 1, "total", removed_so_far, F.col("total") - removed_so_far))
    return totals.select(F.inline(F.array(*lines)))


def distinct_districts(records: DataFrame) -> DataFrame:
    return records.select("District").distinct()


def head_rows(records: DataFrame, order: list[str], n: int = 3) -> DataFrame:
    """The first ``n`` records in a stated order (a top-n, not a full sort)."""
    return records.orderBy(*order).limit(n)


def _is_zero(number: Column) -> Column:
    return number.eqNullSafe(F.lit(0.0))


def _audit_line(step: int, rule: str, removed: Column, remaining: Column) -> Column:
    share = F.when(F.col("total") > 0, F.round(removed * 100.0 / F.col("total"), 1))
    return F.struct(
        F.lit(step).alias("step"),
        F.lit(rule).alias("rule"),
        removed.alias("rows_removed"),
        share.alias("pct_of_input"),
        remaining.alias("rows_remaining"),
    )
