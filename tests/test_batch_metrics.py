from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from roadpulse.operators import batch_metrics as stats
from roadpulse.schemas import SWEEP
from roadpulse.functions.labels import config_text

SCHEMA = (
    "timestamp string, batch_id bigint, rows bigint, duration_sec double,"
    " throughput_rows_per_sec double, config string"
)
FAST, SLOW = config_text("file", "5 seconds", "2 seconds"), config_text("file", "10 seconds", "20 seconds")


def metrics(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_one_warmup_row_goes_per_pair(spark):
    rows = [
        ("10:00", 0, 5, 9.0, 1.0, FAST),
        ("09:00", 0, 5, 8.0, 1.0, FAST),
        ("10:01", 1, 5, 1.0, 5.0, FAST),
        ("10:02", 2, 5, 3.0, None, FAST),
        ("10:00", 7, 5, 4.0, 1.0, SLOW),
        ("10:00", 0, 5, 4.0, 1.0, "default"),
    ]
    parsed = stats.with_config_seconds(metrics(spark, rows))
    kept = sorted((row["batch_id"], row["duration_sec"]) for row in stats.drop_warmup(parsed).collect())
    assert kept == [(0, 9.0), (1, 1.0), (2, 3.0)]
    summary = stats.steady_state_summary(metrics(spark, rows)).collect()
    assert [tuple(row) for row in summary] == [(5, 2, 3, 13 / 3, 3.0, "W5–T2")]


def test_exactly_one_of_equal_copies_goes(spark):
    rows = [("10:00", 0, 5, 9.0, 1.0, FAST)] * 4 + [("10:01", 1, 5, 1.0, 5.0, FAST)] * 2
    parsed = stats.with_config_seconds(metrics(spark, rows).repartition(3))
    assert stats.drop_warmup(parsed).count() == 5


def test_missing_batch_numbers_sort_last(spark):
    rows = [("10:00", None, 5, 9.0, 1.0, FAST), ("10:01", 3, 5, 1.0, 5.0, FAST)]
    summary = stats.steady_state_summary(metrics(spark, rows)).first()
    assert (summary["avg_duration_sec"], summary["batches"]) == (9.0, 0)


def test_warmup_per_run(spark):
    rows = [("10:00", batch, 5, 1.0, 1.0, FAST) for batch in (0, 1, 0, 1)]
    frame = stats.with_config_seconds(metrics(spark, rows[:2]).selectExpr("*", "'a' AS run").unionByName(
        metrics(spark, rows[2:]).selectExpr("*", "'b' AS run")
    ))
    assert stats.drop_warmup(frame).count() == 3
    assert sorted(row["batch_id"] for row in stats.drop_warmup(frame, run="run").collect()) == [1, 1]


def test_sweep_labels_parse(spark):
    rows = [("10:00", 0, 1, 1.0, 1.0, config_text("file", *pair)) for pair in SWEEP]
    got = stats.with_config_seconds(metrics(spark, rows)).select("window_seconds", "trigger_seconds")
    assert sorted(map(tuple, got.collect())) == [(5, 2), (5, 5), (5, 20), (10, 2), (10, 5), (10, 20)]


@pytest.mark.parametrize(
    ("schema", "row", "want"),
    [
        ("rows int, duration_sec string, throughput_rows_per_sec string, config string", (3, "0.5", "6", "c"), (3, 0.5, 6.0, "c")),
        ("rows int, batch_duration int, processed_rps double", (3, 500, 6.0), (3, 0.5, 6.0, "default")),
        ("rows int, duration_sec string, processed_rps double", (3, "x", 6.0), None),
        ("rows int, processed_rps double", (3, 6.0), None),
        ("rows int, duration_sec double", (3, 6.0), None),
        ("rows int, duration_sec double, processed_rps double", (None, 1.0, 6.0), None),
    ],
)
def test_layouts(spark, schema, row, want):
    got = stats.normalise_metrics(spark.createDataFrame([row], schema))
    rows = got.select("rows", "duration_sec", "throughput_rps", "config").collect()
    assert [tuple(r) for r in rows] == ([want] if want else [])


def test_per_config_statistics_equal_pandas(spark):
    rows = [
        ("t", 0, 4, 0.5, 8.0, "a"),
        ("t", 1, 5, 0.7, 10.0, "a"),
        ("t", 2, 9, 0.2, 40.0, "b"),
        ("t", 3, 9, 0.2, 80.0, None),
    ]
    frame = stats.normalise_metrics(metrics(spark, rows))
    table = pd.DataFrame(rows, columns=["timestamp", "batch_id", "rows", "d", "t", "config"])

    def spark_values(result):
        return {row[0]: row[1] for row in result.collect()}

    assert spark_values(stats.batch_size_by_config(frame)) == table.groupby("config")["rows"].mean().to_dict()
    jitter = spark_values(stats.latency_jitter(frame))
    assert jitter["b"] is None
    assert math.isclose(jitter["a"], table.groupby("config")["d"].std()["a"])
    share = (table["t"] / table["t"].max() * 100).groupby(table["config"]).mean().to_dict()
    assert spark_values(stats.throughput_efficiency(frame)) == share
    assert sorted(map(tuple, stats.scaling_curve(frame).collect()))[0] == (4, 0.5)


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    values=st.lists(
        st.one_of(st.integers(0, 40).map(lambda n: n / 10), st.floats(-5, 5, width=32)), min_size=1, max_size=60
    )
)
def test_histogram_equals_numpy(spark, values):
    frame = spark.createDataFrame([(value,) for value in values], "duration_sec double")
    got = stats.latency_histogram(frame).orderBy("bin").collect()
    counts, edges = np.histogram(np.array(values, dtype=float), bins=20)
    assert [row["n"] for row in got] == list(counts)
    np.testing.assert_allclose([row["lo"] for row in got] + [got[-1]["hi"]], edges, rtol=1e-12, atol=1e-12)


def test_histogram_of_a_constant(spark):
    frame = spark.createDataFrame([(2.0,), (2.0,), (None,)], "duration_sec double")
    got = stats.latency_histogram(frame).orderBy("bin").collect()
    assert (got[0]["lo"], got[-1]["hi"], len(got)) == (1.5, 2.5, 20)
    assert [row["n"] for row in got] == list(np.histogram([2.0, 2.0], bins=20)[0])


def test_histogram_of_nothing(spark):
    got = stats.latency_histogram(spark.createDataFrame([], "duration_sec double")).collect()
    assert [row["n"] for row in got] == [0] * 20
