"""What the physical plans must and must not contain."""

from __future__ import annotations

import pytest

from roadpulse import storage
from roadpulse.__main__ import parse
from roadpulse.plans.catalog import QUERIES

BATCH = sorted(name for name in QUERIES if not name.startswith(("stream_", "sweep_", "sink_")))


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_plans_stay_in_the_jvm_without_cross_joins(spark, small, name):
    plan = plan_of(QUERIES[name](spark, small))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "PythonRunner"):
        assert node not in plan
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_flagship_reads_three_columns_and_shuffles_once(spark, small):
    plan = plan_of(QUERIES["congestion_index"](spark, small))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in plan
    assert "PushedFilters: [IsNotNull(ts)]" in plan
    assert plan.count("Exchange") == 1
    assert "partial_avg" in plan and "partial_sum" in plan


def test_region_filter_reaches_the_scan(spark, small):
    plan = plan_of(QUERIES["congestion_index"](spark, small).where("region = 'view'"))
    assert "EqualTo(event_type,view)" in plan


def test_cleaning_needs_no_shuffle(spark, small):
    for name in ("prepared_records", "drop_unobserved", "canonical_reading", "src_json_decode"):
        assert "Exchange" not in plan_of(QUERIES[name](spark, small))


def test_audit_and_quality_take_one_pass(spark, small):
    for name in ("cleaning_audit", "quality_counts"):
        plan = plan_of(QUERIES[name](spark, small))
        assert plan.count("FileScan") == 1
        assert "partial_count" in plan


def test_top_k_is_no_full_sort(spark, small):
    for name in ("peak_congestion", "head_rows", "payload_samples"):
        assert "TakeOrderedAndProject" in plan_of(QUERIES[name](spark, small))


def test_chunk_positions_come_from_a_broadcast_of_partition_counts(spark, small):
    plan = plan_of(QUERIES["chunk_assign"](spark, small))
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan


class Settings(dict):
    """Stands in for a session's settings."""

    @property
    def conf(self):
        return self


def test_shared_folder_is_the_clusters():
    assert storage.shared_folder(Settings({storage.FOLDER_SETTING: "hdfs://x/y/"})) == "hdfs://x/y"
    with pytest.raises(ValueError, match="executors share"):
        storage.shared_folder(Settings({"spark.master": "yarn"}))
    local = Settings({"spark.master": "local[2]"})
    assert storage.shared_folder(local) == storage.shared_folder(local)


def test_command_line():
    options = vars(
        parse(["stream", "--output-path", "o", "--checkpoint-path", "c", "--max-files-per-trigger", "3"])
    )
    assert options["max_files_per_trigger"] == 3
    assert "window" not in options and "console" not in options  # left to the parameters' own defaults
    assert parse(["chunks", "a", "b", "--chunk-size", "1000"]).chunk_size == 1000
