"""What must hold of the physical plans: narrow scans, no cross joins, no single-task exchanges."""

import re

import pytest

from trajloom import queries
from trajloom.operators import blocks

NO_SINGLE = [
    "signal_interp_gaps", "signal_moving_median", "trajectory_continuity", "nearest_reachable_frame", "clip_metadata",
    "retarget_chain", "hand_assembly", "collision_flags", "ledger_sync", "catalog_feedback", "joints_to_camera",
]


def plan(spark, sf, name):
    return queries.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NO_SINGLE)
def test_no_single_task_stage(spark, sf, name):
    text = plan(spark, sf, name)
    assert "SinglePartition" not in text and "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_scan_is_pruned_and_filtered(spark, sf):
    text = plan(spark, sf, "ledger_completed_ids")
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>", text)
    text = plan(spark, sf, "render_success_ratio")
    assert "EqualTo(o_orderstatus,F)" in text


def test_top_ids_are_cut_before_the_shuffle(spark, sf):
    assert "WindowGroupLimit" in plan(spark, sf, "status_sample_ids")


def test_hand_smoothing_shuffles_frames_once(spark, sf):
    """One aggregate and join for the workspace, one shuffle for both hands' smoothers.

    The rounds of long clips read that shuffle again, which the plan shows once it has run.
    """
    df = queries.QUERIES["retarget_chain"](spark, sf)
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    final = text[: text.index("Initial Plan")]
    assert len([x for x in final.splitlines() if "REPARTITION_BY_NUM" in x and "ReusedExchange" not in x]) == 1


@pytest.mark.parametrize("name", ["robust_statistics_overall", "robust_statistics_by_group"])
def test_percentiles_sort_nothing(spark, sf, name):
    """No window, no nested-loop join, and three scans."""
    text = plan(spark, sf, name)
    assert "Window" not in text and "NestedLoopJoin" not in text
    assert len(re.findall(r"FileScan", text)) <= 3


def test_collision_frames_are_dealt_once(spark, sf):
    """Rows are grouped behind their one shuffle by frame, not before it, and no join shuffles them by link."""
    text = plan(spark, sf, "collision_flags")
    assert text.count("hashpartitioning(sample_id") == 1 and "SortMergeJoin" not in text
    assert text.index("partial_min") < text.index("hashpartitioning(sample_id")  # what runs later is printed first


def test_tasks_stay_bounded(spark):
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = [blocks.bounded_parts(spark, rows) for rows in (0, 1 << 19, 1 << 25, 1 << 28, 1 << 29, 1 << 32)]
    assert parts == [own, own, 64, 200, 200, 1024]
