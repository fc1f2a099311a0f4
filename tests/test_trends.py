from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roadpulse.operators import trends
from roadpulse.operators.windows import typed_window_aggregate, window_aggregate

SCHEMA = (
    "region string, window_start timestamp_ntz, avg_speed double, total_vehicles bigint,"
    " congestion_index double"
)
START = dt.datetime(2024, 1, 1)


def aggregates(spark, rows):
    return spark.createDataFrame(
        [(region, START + dt.timedelta(hours=hours), *rest) for region, hours, *rest in rows], SCHEMA
    )


def as_pandas(rows):
    frame = pd.DataFrame(
        [(region, START + dt.timedelta(hours=hours), *rest) for region, hours, *rest in rows],
        columns=["region", "window_start", "avg_speed", "total_vehicles", "congestion_index"],
    )
    return frame.astype({"avg_speed": float, "congestion_index": float, "total_vehicles": float})


measure = st.one_of(st.none(), st.integers(0, 50).map(float))
history = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", None]),
        # Far apart, so that days hold no, one, two or many windows.
        st.one_of(st.integers(0, 30), st.integers(0, 400)),
        measure,
        st.one_of(st.none(), st.integers(0, 9)),
        measure,
    ),
    min_size=1,
    max_size=40,
    unique_by=lambda row: row[:2],
)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=history, n=st.integers(1, 5))
def test_rolling_mean_equals_pandas(spark, rows, n):
    got = trends.rolling_mean(aggregates(spark, rows), {"roll": "avg_speed"}, rows=n).toPandas()
    frame = as_pandas(rows).sort_values("window_start", kind="stable")
    frame["roll"] = frame.groupby("region")["avg_speed"].transform(
        lambda series: series.rolling(n, min_periods=1).mean()
    )
    order = ["region", "window_start"]
    got = got.sort_values(order).reset_index(drop=True)
    want = frame.sort_values(order).reset_index(drop=True)
    assert len(got) == len(want)
    np.testing.assert_allclose(got["roll"].astype(float), want["roll"], atol=1e-9)


def test_rolling_skips_missing_values(spark):
    rows = [("a", hour, speed, 1, None) for hour, speed in enumerate([1.0, None, 3.0, None, None, None])]
    got = trends.rolling_measures(aggregates(spark, rows)).orderBy("window_start")
    assert [row["avg_speed_roll"] for row in got.collect()] == [1, 1, 2, 3, 3, None]


def test_rolling_reaches_over_empty_days(spark):
    rows = [("a", hour, float(speed), 1, 0.0) for hour, speed in [(0, 3), (24 * 9, 6), (24 * 40, 9)]]
    got = trends.rolling_measures(aggregates(spark, rows)).orderBy("window_start")
    assert [row["avg_speed_roll"] for row in got.collect()] == [3.0, 4.5, 6.0]
    assert got.columns == [*aggregates(spark, rows).columns, "avg_speed_roll", "congestion_roll"]


def test_no_slot_of_a_hot_region_holds_its_history(spark):
    """One region with nearly all rows is still cut into days for sorting."""
    rows = [("hot", hour, float(hour), 1, 0.0) for hour in range(24 * 60)] + [("b", 0, 1.0, 1, 0.0)]
    rolled = trends.rolling_measures(aggregates(spark, rows))
    values = [row[0] for row in rolled.where("region = 'hot'").orderBy("window_start").select("avg_speed_roll").collect()]
    assert values == [0.0, 0.5, *[float(hour - 1) for hour in range(2, 24 * 60)]]
    plan = rolled._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=history, metric=st.sampled_from(["avg_speed", "total_vehicles", "congestion_index"]))
def test_pivot_equals_pandas(spark, rows, metric):
    doubled = rows + rows[:3]
    got = trends.pivot_by_region(aggregates(spark, doubled), metric).toPandas()
    want = as_pandas(doubled).pivot_table(
        index="window_start", columns="region", values=metric, aggfunc="mean"
    )
    got = got.set_index("window_start").sort_index()
    assert list(got.columns) == list(want.columns)
    assert list(got.index) == list(want.index)
    np.testing.assert_allclose(got.to_numpy(dtype=float), want.to_numpy(dtype=float))


def test_too_many_regions_are_an_error(spark):
    rows = [(f"r{number}", 0, 1.0, 1, 1.0) for number in range(4)]
    with pytest.raises(ValueError, match="more than 3"):
        trends.regions_with(aggregates(spark, rows), "avg_speed", limit=3)
    assert trends.regions_with(aggregates(spark, rows), "avg_speed", limit=4) == ["r0", "r1", "r2", "r3"]


def test_peaks(spark):
    rows = [
        ("b", 1, 1.0, 1, 5.0),
        ("a", 2, 1.0, 1, 5.0),
        ("a", 1, 1.0, 1, 5.0),
        (None, 0, 1.0, 1, 5.0),
        ("c", 0, 1.0, 1, None),
        ("a", 3, 1.0, 1, 9.0),
    ]
    got = trends.peak_congestion(aggregates(spark, rows), 6).collect()
    hours = [(row["region"], (row["window_start"] - START).seconds // 3600) for row in got]
    assert hours == [("a", 3), ("a", 1), ("a", 2), ("b", 1), (None, 0), ("c", 0)]
    plain = as_pandas([row for row in rows if row[0]]).sort_values(["region", "window_start"])
    best = plain.nlargest(3, "congestion_index")
    assert [(row["region"], row["window_start"]) for row in got[:3]] == [
        (region, start.to_pydatetime()) for region, start in zip(best["region"], best["window_start"])
    ]


def test_sorted_and_points(spark):
    rows = [(None, 0, 1.0, 1, 1.0), ("b", 1, 2.0, 1, None), ("a", 2, 3.0, 1, 1.0), ("a", 1, None, 1, 1.0)]
    frame = aggregates(spark, rows)
    assert [row["region"] for row in trends.sorted_aggregates(frame).collect()] == ["a", "a", "b", None]
    assert trends.congestion_against_speed(frame).count() == 3


READINGS = "ts timestamp_ntz, region string, road_id string, vehicle_count int, speed double"


def readings(spark, rows):
    return spark.createDataFrame(
        [(START + dt.timedelta(seconds=s), region, "r", count, speed) for s, region, count, speed in rows],
        READINGS,
    )


def test_window_aggregate(spark):
    rows = [
        (0, "a", 10, 40.0),
        (4.999, "a", 2, None),
        (5, "a", None, 20.0),
        (0, None, 1, 10.0),
        (0, "zero", 3, 0.0),
        (0, "none", 3, None),
    ]
    got = window_aggregate(readings(spark, rows), "5 seconds")
    found = {
        (row["region"], (row["window_start"] - START).seconds): tuple(row)[3:] for row in got.collect()
    }
    assert found == {
        ("a", 0): (40.0, 12, 0.3),
        ("a", 5): (20.0, None, None),
        (None, 0): (10.0, 1, 0.1),
        ("zero", 0): (0.0, 3, None),
        ("none", 0): (None, 3, None),
    }


reading = st.tuples(
    st.integers(0, 90),
    st.sampled_from(["a", "b", None]),
    st.one_of(st.none(), st.integers(0, 99)),
    st.one_of(st.none(), st.integers(0, 40).map(float)),
)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(reading, min_size=1, max_size=40), width=st.sampled_from([5, 10, 60]))
def test_window_aggregate_equals_brute_force(spark, rows, width):
    groups = {}
    for second, region, count, speed in rows:
        groups.setdefault((region, second // width * width), []).append((count, speed))
    want = {}
    for key, members in groups.items():
        counts = [count for count, _ in members if count is not None]
        speeds = [speed for _, speed in members if speed is not None]
        mean = sum(speeds) / len(speeds) if speeds else None
        total = sum(counts) if counts else None
        index = total / mean if mean and total is not None else None
        want[key] = (mean, total, index)
    got = {}
    for row in window_aggregate(readings(spark, rows), f"{width} seconds").collect():
        assert row["window_end"] - row["window_start"] == dt.timedelta(seconds=width)
        start = int((row["window_start"] - START).total_seconds())
        got[row["region"], start] = (row["avg_speed"], row["total_vehicles"], row["congestion_index"])
    assert got.keys() == want.keys()
    for key, (mean, total, index) in want.items():
        assert got[key][:2] == (pytest.approx(mean), total)
        assert got[key][2] == (None if index is None else pytest.approx(index, abs=0.0051))


def test_hot_key_is_combined_before_the_shuffle(spark):
    hot = spark.range(0, 300_000, numPartitions=4).select(
        F.lit(START).cast("timestamp_ntz").alias("ts"),
        F.when(F.col("id") % 3 < 2, "hot").otherwise(F.col("id").cast("string")).alias("region"),
        F.lit("r").alias("road_id"),
        F.lit(1).alias("vehicle_count"),
        F.lit(2.0).alias("speed"),
    )
    row = window_aggregate(hot, "1 hour").where("region = 'hot'").first()
    assert (row["total_vehicles"], row["avg_speed"], row["congestion_index"]) == (200_000, 2.0, 100_000.0)


def test_typed_aggregate(spark):
    frame = spark.createDataFrame(
        [(START, "a", 1.005, 10.0), (START, "a", 2.0, 15.05), (START, "a", None, None)],
        "ts timestamp_ntz, region string, `Total Flow` double, `Avg Speed` double",
    )
    row = typed_window_aggregate(frame, "5 seconds").first()
    assert (row["avg_speed"], row["total_vehicles"]) == (12.53, 3.01)
