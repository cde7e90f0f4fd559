"""Shape of the physical plans of the registered queries."""

from __future__ import annotations

import re

import pytest

from fleetlake import fixtures, registry
from fleetlake.operators import fleet, reports
from fleetlake.plans.append import append
from fleetlake.sources.layers import read_table

FOLDER = "/root/testdata/sf0.001"
# Queries that write tables first; their reads are plain scans.
JOBS = {
    "read_silver",
    "compact_day",
    "compact_counts",
    "idempotent_append",
    "backfill_counts",
    "retention_apply",
    "reconcile_layers",
    "reconcile_layers_by_day",
    "stream_ingest",
    "stream_ingest_predictions",
}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - JOBS))
def test_plan(spark, name):
    plan = plan_of(registry.QUERIES[name](spark, FOLDER))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert unwanted not in plan
    # No column beyond those of the query is read, and never the wide text column.
    assert "props" not in plan
    # A window always has a partition; without one, all rows meet in one task.
    assert not re.search(r"windowspecdefinition\([a-z_]+#\d+L? (ASC|DESC)", plan)


def test_aggregation_reads_two_columns(spark, tmp_path, make_status):
    path = str(tmp_path / "fleet_status")
    append(make_status((1, "2025-08-15 10:00:00", 1, "A", 0.0, 0.0)), path, "fleet_status")
    plan = plan_of(reports.top_lines_by_volume(read_table(spark, path, "fleet_status")))
    assert "ReadSchema: struct<line_code:string,next_stop_id:bigint>" in plan


def test_line_filter_reaches_the_scan(spark, tmp_path, make_status):
    path = str(tmp_path / "fleet_status")
    append(make_status((1, "2025-08-15 10:00:00", 1, "A", 0.0, 0.0)), path, "fleet_status")
    plan = plan_of(fleet.latest_position(read_table(spark, path, "fleet_status"), "A"))
    assert "EqualTo(line_code,A)" in plan
    assert "position_at" not in plan


def test_unused_predictions_are_not_joined(spark):
    track = fixtures.vehicle_track(fixtures.events(spark, FOLDER))
    assert "Join" not in plan_of(fleet.stuck_vehicles(track))
